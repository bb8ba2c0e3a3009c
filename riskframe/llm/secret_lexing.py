"""Secret scans by assignment-aware lexing: name-literal pairs, propagated constants, literals scored by name."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order that settles equal starts. The first three are the base rules.
KINDS = ("assign", "access", "hex", "named")
#: A literal counts as a secret from this score on (name weight times literal weight).
LEAST_SCORE = 0.5

# The base rules.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 16
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_HINT = re.compile(r"passw|secret|token|api_?key")

# Parts of names that make a literal more or less likely to be a secret.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.8, "pw": 0.7,
    "secret": 1.0, "secrets": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9, "credentials": 0.9,
    "privatekey": 1.0, "accesskey": 0.9, "secretkey": 1.0, "signingkey": 0.9, "encryptionkey": 0.9,
    "auth": 0.6, "bearer": 0.8, "key": 0.5, "api": 0.4, "private": 0.5, "signature": 0.5, "salt": 0.5,
    "public": -0.6, "url": -0.5, "uri": -0.5, "path": -0.6, "file": -0.6, "name": -0.5, "count": -0.6,
    "length": -0.6, "policy": -0.6, "hint": -0.6, "label": -0.6, "field": -0.6, "type": -0.5, "id": -0.3,
}
MARKS = re.compile(r"(?i)example|changeme|placeholder|your[_-]|dummy|redacted")
PLACEHOLDER = re.compile(
    rf"(?i)^(?:.*(?:{MARKS.pattern[4:]}).*|(.)\1*|<.*>|\$\{{.*\}}|null|none|true|false)$")
ALIKE = re.compile(r"(?i)(.)\1*")
#: Length of the longest mark.
EDGE = len("placeholder")

_LITERAL = r'"(?:[^"\\\n]|\\.)*"' + r"|'(?:[^'\\\n]|\\.)*'" + r"|`[^`\n]*`"
_REFERENCE = r"\$\{[A-Za-z_][\w.]*\}|\$?[A-Za-z_][\w.]*"
_BARE = r"[^\s\"'`,;(){}\[\]<>]+"
_PAIR = re.compile(
    r"""(?<![\w.\-])["'`]?(?P<name>[A-Za-z_][\w.\-]*)["'`]?[ \t]*(?:=>|:=|=(?!=)|:(?!//|:))[ \t]*"""
    rf"(?P<value>(?:{_LITERAL}|{_BARE})(?:[ \t]*\+[ \t]*(?:{_LITERAL}|{_BARE}))*)")
_TERM = re.compile(rf"(?P<quoted>{_LITERAL})|(?P<bare>{_BARE})")
_INSIDE = re.compile(r"\$?\{([A-Za-z_][\w.]*)\}")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


@dataclass(frozen=True)
class Finding:
    kind: str
    start: int
    end: int
    name: str | None
    score: float
    # Where the secret itself lies, which is what a mask replaces.
    value_start: int
    value_end: int

    def order(self) -> tuple:
        return self.start, KINDS.index(self.kind), self.end


def base_findings(text: str) -> list[Finding]:
    """Matches of the three base rules, leftmost and non-overlapping for each kind."""
    out = []
    # No letter outside ASCII becomes one of these in lower case but for two, which the rule then rejects.
    if ASSIGN_HINT.search(text.lower()):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                out.append(Finding("assign", *m.span(), m[1], 1.0, *m.span(2)))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= ACCESS_LEAST:
                out.append(Finding("access", *m.span(), None, 1.0, *m.span()))
    for m in HEX.finditer(text):
        out.append(Finding("hex", *m.span(), None, 1.0, *m.span()))
    return out


def name_weight(name: str) -> float:
    """How strongly a name announces a secret, 0 to 1: its parts, and neighbouring parts read as one word."""
    parts = [part.lower() for part in _PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    weights = [NAME_WEIGHTS[part] for part in {*parts, *joined} if part in NAME_WEIGHTS]
    best = max([0.0, *weights])
    return max(0.0, min(1.0, best + min([0.0, *weights])))


class Summary:
    """All that ``literal_weight`` needs of a text put together from pieces, in bounded space.

    Doubling a text doubles the integers in here, which are exact whatever the length.
    """

    def __init__(self, *pieces: str | Summary):
        self.length, self.counts, self.marked, self.head, self.tail = 0, Counter(), False, "", ""
        for piece in pieces:
            self._add(piece)

    def _add(self, piece: str | Summary) -> None:
        if isinstance(piece, str):
            length, head, tail = len(piece), piece[:EDGE], piece[-EDGE:]
            self.counts.update(piece)
            self.marked = self.marked or bool(MARKS.search(piece))
        else:
            length, head, tail = piece.length, piece.head, piece.tail
            for c, n in piece.counts.items():
                self.counts[c] += n
            self.marked = self.marked or piece.marked
        # A mark may lie over the seam; edges as long as the longest mark show it.
        self.marked = self.marked or bool(MARKS.search(self.tail + head))
        self.head = (self.head + head)[:EDGE]
        self.tail = (self.tail + tail)[-EDGE:]
        self.length += length

    def placeholder(self) -> bool:
        """Whether ``PLACEHOLDER`` matches the text, for texts of eight code points or more."""
        enclosed = self.head.startswith("<") and self.tail.endswith(">") or (
            self.head.startswith("${") and self.tail.endswith("}"))
        return self.marked or enclosed or bool(ALIKE.fullmatch("".join(self.counts)))


def literal_weight(value: str | Summary) -> float:
    """How much a literal looks like a secret, 0 to 1: length, entropy, mixed characters, no placeholder."""
    if isinstance(value, str):
        if len(value) < 8 or PLACEHOLDER.match(value):
            return 0.0
        length, counts = len(value), Counter(value)
    else:
        if value.length < 8 or value.placeholder():
            return 0.0
        length, counts = value.length, value.counts
    if any(c.isspace() for c in counts):
        return 0.0
    # A share too small for a float has no weight.
    shares = [share for n in counts.values() if (share := n / length) > 0]
    bits = -sum(share * math.log2(share) for share in shares)
    classes = sum(any(test(c) for c in counts) for test in (str.islower, str.isupper, str.isdigit)) + (
        any(not c.isalnum() for c in counts))
    return min(1.0, bits / 3.5) * (1.0 if classes >= 2 else 0.5)


def _known(name: str, constants: dict[str, str | Summary]) -> Summary | None:
    """The constant of a name; it is summarised once, where it is first used."""
    found = constants.get(name)
    if isinstance(found, str):
        found = constants[name] = Summary(found)
    return found


def _resolve(value: str, constants: dict[str, str | Summary]) -> str | Summary:
    """A value's literals, known constants, and constants inside literals, joined: a text without, a summary with constants."""
    pieces = []
    for term in _TERM.finditer(value):
        if term["quoted"]:
            at, end = term.start() + 1, term.end() - 1
            for m in _INSIDE.finditer(value, at, end):
                found = _known(m[1], constants)
                if found is not None:
                    pieces += [value[at:m.start()], found]
                    at = m.end()
            pieces.append(value[at:end])
        elif term["bare"] != "+":
            found = _known(term["bare"].strip("${}"), constants)
            pieces.append(term["bare"] if found is None else found)
    pieces = [piece for piece in pieces if piece != ""]
    if all(isinstance(piece, str) for piece in pieces):
        return "".join(pieces)
    return pieces[0] if len(pieces) == 1 else Summary(*pieces)


def _value_span(pair: re.Match) -> tuple[int, int]:
    """Where the value of a pair lies; without the quotes if it is one literal."""
    start, end = pair.span("value")
    alone = _TERM.fullmatch(pair["value"])
    return (start + 1, end - 1) if alone and alone["quoted"] else (start, end)


def named_findings(text: str) -> list[Finding]:
    """Name-literal pairs whose literal, with constants put in, scores as a secret under the pair's name."""
    out, constants, literals = [], {}, {}
    if "=" not in text and ":" not in text:
        return out
    for m in _PAIR.finditer(text):
        name, value = m["name"], m["value"]
        resolved = _resolve(value, constants)
        weight = name_weight(name)
        if weight > 0:
            score = weight * literal_weight(resolved)
            if score >= LEAST_SCORE:
                out.append(Finding("named", *m.span(), name, round(score, 4), *_value_span(m)))
                # A constant that ends up under a sensitive name is the secret, wherever it was written.
                for term in re.findall(_REFERENCE, value):
                    source = literals.get(term.strip("${}"))
                    if source and literal_weight(_known(term.strip("${}"), constants)) > 0:
                        out.append(Finding("named", *source[:2], name, round(score, 4), *source[2:]))
        constants[name], literals[name] = resolved, (*m.span(), *_value_span(m))
    return list({(f.start, f.end): f for f in out}.values())


def find_secrets(text: str | None) -> list[Finding]:
    """All findings in order; a named pair whose whole value a base assignment covers is not told twice."""
    if not text:
        return []
    base = base_findings(text)
    # Ends and starts of the base values, which rise together: only the first that ends late enough can cover.
    taken = [f for f in base if f.kind == "assign"]
    ends = [f.value_end for f in taken]

    def covered(f: Finding) -> bool:
        at = bisect_left(ends, f.value_end)
        return at < len(taken) and taken[at].value_start <= f.value_start

    return sorted([*base, *(f for f in named_findings(text) if not covered(f))], key=Finding.order)


FINDINGS = "array<struct<kind: string, start: long, end: long, name: string, score: double>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, findings`` for each row; offsets in code points, ends exclusive.

    Whole texts are lexed, one row at a time, where they are read. Null and empty texts
    have no findings. Repeated rows give repeated results, null ids stay null, other
    columns are ignored, an empty table gives an empty result.
    """
    @F.pandas_udf(FINDINGS)
    def findings(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": f.kind, "start": f.start, "end": f.end, "name": f.name, "score": f.score}
                           for f in find_secrets(text)] for text in texts.tolist()], dtype=object)

    # The id stays in the JVM: Python would turn ids beside a null into doubles.
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), findings(F.col(text_col)).alias("findings"))


def mask_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with each secret replaced; overlapping secrets get one mark."""
    findings = find_secrets(text)
    if not findings:
        return text
    out, at = [], 0
    for start, end in sorted((f.value_start, f.value_end) for f in findings):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with the secrets in ``text_col`` masked; ``length_col`` then counts the new text's code points."""
    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([mask_text(text) for text in texts.tolist()], dtype=object)

    out = docs.withColumn(text_col, masked(F.col(text_col)))
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.length(text_col).cast(kind))
    return out
