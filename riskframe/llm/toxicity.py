"""Toxicity by weak supervision: a generative label model over many voters, then a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.samples import labelled_sample

#: Labelled rows that the models are fitted on, about, at most.
FIT_ROWS = 20_000
#: Patterns that become voters at most and of one stem at most, and how sure (standard deviations) and frequent
#: they must be.
MOST_PATTERNS, MOST_OF_STEM, LEAST_Z, LEAST_ROWS = 600, 2, 3.0, 4
#: First letters that make a stem; words on one stem from which a voter fires, as a count and per thousand words.
STEMS, COUNTS, SHARES = (3, 4, 5), (1, 2, 3, 5, 8, 13), (20, 50, 100, 200)
#: How often the given label is 1 on toxic and on clean rows. It anchors the label model, EM does not move it.
TRUST = (0.98, 0.003)
#: Residual correlation from which two voters are of one block.
BLOCK_CORRELATION = 0.2
#: A score from which a document is called toxic.
CUTOFF = 0.7
_ROUNDS, _RIDGE = 12, 1.0

# Insults of the lexicon voters.
LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting",
           "imbecile", "dumb", "filth", "vermin", "bastard", "bitch", "asshole", "retard", "cretin", "pig")
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str | None) -> tuple[str, list[str]]:
    low = (text or "").lower()
    return low, _WORD.findall(low)


def stem_votes(count: int, words: int) -> list[str]:
    """What ``count`` of ``words`` words on one stem say: ``c3`` at least 3 of them, ``s50`` at least 50 in a thousand."""
    out = [f"c{n}" for n in COUNTS if count >= n]
    return out + [f"s{n}" for n in SHARES if count > 1 and 1000 * count >= n * words]


def patterns_of(words: list[str]) -> set[str]:
    """Candidate voters in a text: short words whole (``word=``), and how often words lie on a stem (``stem*c3``)."""
    counts: Counter = Counter()
    short = set()
    for word, n in Counter(words).items():
        if len(word) <= 5:
            short.add(word + "=")
        for size in STEMS:
            if len(word) > size:
                counts[word[:size]] += n
    return short.union(f"{stem}*{vote}" for stem, n in counts.items() for vote in stem_votes(n, len(words)))


@dataclass(frozen=True)
class Voters:
    """The learned patterns; the lexicon and the fixed patterns come before them."""

    patterns: tuple[str, ...]

    @property
    def names(self) -> tuple[str, ...]:
        fixed = ("any_insult", "two_insults", "dense_insults", "shouted_insult", "any_pattern", "two_patterns")
        return (*LEXICON, *fixed, *self.patterns)

    def index(self) -> tuple[dict[str, int], frozenset[str]]:
        """The place of each voter, and the stems that any of them looks at."""
        return {name: i for i, name in enumerate(self.names)}, frozenset(
            p.partition("*")[0] for p in self.patterns if "*" in p)

    def votes(self, text: str | None, known: tuple[dict[str, int], frozenset[str]]) -> list[int]:
        """Positions of the voters that call the text toxic; the others call it clean."""
        index, stems = known
        _, words = _words(text)
        distinct = Counter(words)
        fired = []
        insults = _LEXICON.intersection(distinct)
        if insults:
            fired += [index[w] for w in insults]
            fired.append(index["any_insult"])
            if len(insults) > 1:
                fired.append(index["two_insults"])
            if sum(distinct[w] for w in insults) >= 0.01 * len(words):
                fired.append(index["dense_insults"])
            if any(w.upper() in (text or "") for w in insults):
                fired.append(index["shouted_insult"])
        found, counts = [], {}
        for word, n in distinct.items():
            if len(word) <= 5:
                place = index.get(word + "=")
                if place is not None:
                    found.append(place)
            for size in STEMS:
                if len(word) > size and (stem := word[:size]) in stems:
                    counts[stem] = counts.get(stem, 0) + n
        for stem, n in counts.items():
            found += [index[p] for vote in stem_votes(n, len(words)) if (p := f"{stem}*{vote}") in index]
        fired += found
        if found:
            fired.append(index["any_pattern"])
        if len(found) > 1:
            fired.append(index["two_patterns"])
        return sorted(fired)


_LEXICON = frozenset(LEXICON)


@dataclass(frozen=True)
class Toxicity:
    """Voters with the weights of the linear classifier."""

    voters: Voters
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        index = self.voters.index()
        sums = [self.weights[self.voters.votes(text, index)].sum() for text in texts]
        return _sigmoid(np.array(sums, dtype=float) + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def learn_voters(sample: DataFrame) -> Voters:
    """Word patterns that are clearly more frequent in toxic rows: counted by Spark, the best reach the driver.

    Of one stem only the surest patterns count, so that the words of one language do not
    crowd out those of another.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"].tolist(), batch["label"].tolist(), strict=True):
                found[label == 1].update(patterns_of(_words(text)[1]))
        keys = list(found[0].keys() | found[1].keys())
        if keys:
            yield pd.DataFrame({"pattern": keys, "clean": [found[0][k] for k in keys],
                                "toxic": [found[1][k] for k in keys]})

    totals = sample.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    toxic, clean = totals["toxic"] or 0, totals["clean"] or 0
    counts = sample.select("text", "label").mapInPandas(count, "pattern string, clean long, toxic long")
    counts = counts.groupBy("pattern").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = [F.log((F.col(side) + 0.5) / (F.lit(total) - F.col(side) + 0.5))
            for side, total in (("toxic", toxic), ("clean", clean))]
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = counts.where(F.col("toxic") >= LEAST_ROWS).withColumn("z", (odds[0] - odds[1]) / spread)
    place = Window.partitionBy(F.regexp_replace("pattern", r"\*.*$", "*")).orderBy(F.desc("z"), "pattern")
    best = best.where(F.col("z") >= LEAST_Z).withColumn("place", F.row_number().over(place))
    best = best.where(F.col("place") <= MOST_OF_STEM).orderBy(F.desc("z"), "pattern").limit(MOST_PATTERNS)
    return Voters(tuple(row["pattern"] for row in best.collect()))


def blocks_of(correlation: np.ndarray, least: float = BLOCK_CORRELATION) -> np.ndarray:
    """The block of each voter: voters are of one block if a chain of correlated ones joins them."""
    label = np.arange(len(correlation))
    i, j = np.nonzero(correlation > least)
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


def label_model(fired: np.ndarray, labels: np.ndarray, trust: tuple[float, float] = TRUST) -> np.ndarray:
    """Posterior probability that each row is toxic.

    Every column of ``fired`` (0/1) is a voter. EM estimates for each how often it fires on toxic and on
    clean rows, that is its accuracy. The given label is one more voter, whose accuracy ``trust`` is held, so the
    latent class stays the one that is labelled. Voters that agree more than the latent class
    explains are correlated: a block of ``k`` of them with mean residual correlation ``r`` shares one
    factor and weighs as ``k / (1 + (k - 1) * r)`` independent voters.
    """
    hit, slip = trust
    given = np.where(labels == 1, np.log(hit / slip), np.log((1 - hit) / (1 - slip)))
    posterior = np.where(labels == 1, hit, slip)
    together = (fired.T @ fired).astype(np.float64)
    for _ in range(_ROUNDS):
        share = np.clip(posterior.mean(), 1e-4, 1 - 1e-4)
        on_toxic = ((posterior.astype(np.float32) @ fired).astype(np.float64) + 0.1) / (posterior.sum() + 1)
        on_clean = (((1 - posterior).astype(np.float32) @ fired).astype(np.float64) + 0.1) / ((1 - posterior).sum() + 10)
        on_toxic, on_clean = np.clip(on_toxic, 1e-6, 1 - 1e-6), np.clip(on_clean, 1e-6, 1 - 1e-6)
        # Covariance of what the latent class leaves unexplained, without a second table of its size.
        soft = np.stack([posterior, 1 - posterior])
        rates = np.stack([on_toxic, on_clean])
        crossed = (soft.astype(np.float32) @ fired).T @ rates
        cover = (together - crossed - crossed.T + rates.T @ (soft @ soft.T) @ rates) / len(fired)
        scale = np.sqrt(np.clip(np.diag(cover), 1e-12, None))
        correlation = np.clip(cover / np.outer(scale, scale), 0, 1)
        np.fill_diagonal(correlation, 0)
        discount, block = np.ones(len(correlation)), blocks_of(correlation)
        for value in np.unique(block):
            members = np.flatnonzero(block == value)
            discount[members] = 1 / (1 + correlation[np.ix_(members, members)].sum() / len(members))
        gain = discount * (np.log(on_toxic / on_clean) - np.log((1 - on_toxic) / (1 - on_clean)))
        base = np.log(share / (1 - share)) + (discount * np.log((1 - on_toxic) / (1 - on_clean))).sum()
        updated = _sigmoid((fired @ gain.astype(np.float32)).astype(np.float64) + base + given)
        moved = np.abs(updated - posterior).max()
        posterior = updated
        if moved < 1e-4:
            break
    return posterior


def linear_classifier(fired: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression of soft labels on the votes, by Newton steps with a ridge; the bias is free."""
    x = np.column_stack([fired, np.ones(len(fired), dtype=np.float32)])
    ridge = np.full(x.shape[1], _RIDGE)
    ridge[-1] = 1e-6
    weights = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid((x @ weights.astype(np.float32)).astype(np.float64))
        heavy = (p * (1 - p)).astype(np.float32)
        # Rows of a block at a time, so the weighted copy stays small.
        curve = sum((x[i:i + 2000] * heavy[i:i + 2000, None]).T @ x[i:i + 2000] for i in range(0, len(x), 2000))
        step = np.linalg.solve(curve.astype(np.float64) + np.diag(ridge + 1e-9),
                               (x.T @ (p - target).astype(np.float32)).astype(np.float64) + ridge * weights)
        weights -= step
        if np.abs(step).max() < 1e-5:
            break
    return weights[:-1], float(weights[-1])


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, where: Column | None = None, label_col: str = "toxic",
    most_rows: int = FIT_ROWS,
) -> Toxicity:
    """Voters, label model and classifier from at most about ``most_rows`` labelled rows.

    ``where`` (on ``doc_id``) says which labels may be used. The driver gets the voters
    that fired, for the sampled rows only. Without labels the lexicon alone decides.
    """
    sample = labelled_sample(docs, labels, label_col, most_rows, where)
    voters = learn_voters(sample)

    @F.pandas_udf("array<int>")
    def votes(texts: pd.Series) -> pd.Series:
        index = voters.index()
        return pd.Series([voters.votes(text, index) for text in texts.tolist()], dtype=object)

    rows = sample.select("doc_id", "label", votes("text").alias("fired")).orderBy("doc_id", "label").collect()
    size = len(voters.names)
    if not rows or len({row["label"] for row in rows}) < 2:
        weights = np.zeros(size)
        weights[voters.index()[0]["any_insult"]] = 6.0
        return Toxicity(voters, weights, -3.0)
    fired = np.zeros((len(rows), size), dtype=np.float32)
    for i, row in enumerate(rows):
        fired[i, row["fired"]] = 1
    given = np.array([row["label"] for row in rows])
    weights, bias = linear_classifier(fired, label_model(fired, given))
    return Toxicity(voters, weights, bias)


def _scorer(spark: SparkSession, model: Toxicity):
    """A column function of scores; each whole text is scored where it is read."""
    shared = spark.sparkContext.broadcast(model)  # of a fixed size

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.tolist()))

    return score


def score_toxicity(spark: SparkSession, docs: DataFrame, model: Toxicity, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more likely toxic) and ``predicted`` (1 from the cutoff on).

    Null and empty texts get the score of a text without any vote. Rows keep their other columns, repeated rows are
    scored each, an empty table stays empty.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*kept, _scorer(spark, model)(F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))


def drop_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not called toxic, by a model learned from the labels of ``docs``.

    Rows and columns are as they came; null and empty texts stay unless a text without any vote is called toxic.
    """
    return docs.where(_scorer(spark, fit_toxicity(docs, labels))(F.col("text")) < CUTOFF)
