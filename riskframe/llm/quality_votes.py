"""Quality by nearest-neighbour voting over latent-semantic vectors of labelled documents."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.samples import labelled_sample

#: Labelled documents that vote, about, at most; their vectors are broadcast.
VOTERS = 4000
#: Hash buckets of terms, latent dimensions, neighbours asked, documents in a block of products.
TERMS, LATENT, NEIGHBOURS, BLOCK = 2048, 64, 25, 256
#: The power of the cosine that weighs a neighbour's label.
SHARPNESS = 4
#: A score from which a document is called good.
CUTOFF = 0.3

_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_CACHE_TOKENS = 400_000
_cache: dict[str, tuple[int, ...]] = {}


def _bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % TERMS


def _case(word: str) -> str:
    return "a" if word.islower() else "A" if word.isupper() and len(word) > 1 else "Aa" if word.istitle() else "aA"


def token_terms(token: str) -> tuple[int, ...]:
    """Buckets of a token's terms: its shape, its marks, and the word itself if it is short."""
    shape = _case(token) if token.isalpha() else _DIGITS.sub("0", _LETTERS.sub(lambda m: _case(m[0]), token))[:12]
    terms = [f"s {shape}", f"n {min(len(token), 20) // 3}"]
    if len(token) <= 4:
        terms.append(f"w {token.lower()}")
    terms += [f"m {mark}" for mark in set(token) if not mark.isalnum() and mark not in ".,"]
    return tuple(_bucket(term) for term in terms)


def term_counts(text: str | None) -> np.ndarray:
    """How often each bucket of terms occurs in the whole text; lines count by length and repetition."""
    counts = np.zeros(TERMS, dtype=np.float32)
    if not text:
        return counts
    tokens = Counter(text.split())
    ids: list[int] = []
    weights: list[int] = []
    for token, n in tokens.items():
        terms = _cache.get(token)
        if terms is None:
            if len(_cache) >= _CACHE_TOKENS:
                _cache.clear()
            terms = _cache[token] = token_terms(token)
        ids += terms
        weights += [n] * len(terms)
    lines = Counter(line for line in text.split("\n") if line)
    for line, n in lines.items():
        ids.append(_bucket(f"l {len(line).bit_length()}"))
        weights.append(n)
        if n > 1:
            ids.append(_bucket(f"r {n.bit_length()}"))
            weights.append(n)
    return np.bincount(ids, weights=weights, minlength=TERMS).astype(np.float32)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return np.log1p(counts) * idf


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


@dataclass(frozen=True)
class QualityVotes:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The label mean of the nearest labelled documents, weighted by similarity; exact, block by block."""
        out = np.full(len(texts), self.prior)
        if not len(self.labels):
            return out
        near = min(NEIGHBOURS, len(self.labels))
        for i in range(0, len(texts), BLOCK):
            counts = np.stack([term_counts(text) for text in texts[i:i + BLOCK]])
            vectors = _unit(_weighted(counts, self.idf) @ self.axes)
            cosines = vectors @ self.vectors.T
            best = np.argpartition(-cosines, near - 1, axis=1)[:, :near]
            weight = np.clip(np.take_along_axis(cosines, best, axis=1), 0, 1).astype(float) ** SHARPNESS
            # The prior has the weight of one far neighbour, so texts like nothing known get it.
            votes = (weight * self.labels[best]).sum(axis=1) + 0.01 * self.prior
            out[i:i + BLOCK] = votes / (weight.sum(axis=1) + 0.01)
        return out


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all documents each bucket of terms occurs, and the number of documents."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size = np.zeros(TERMS, dtype=np.int64), 0
        for batch in batches:
            size += len(batch)
            for text in batch["text"].tolist():
                found += term_counts(text) > 0
        yield pd.DataFrame({"term": [*range(TERMS), -1], "n": [*found.tolist(), size]})

    rows = docs.select(F.col(text_col).alias("text")).mapInPandas(count, "term int, n long")
    sums = {row["term"]: row["n"] for row in rows.groupBy("term").agg(F.sum("n").alias("n")).collect()}
    return np.array([sums.get(term, 0) for term in range(TERMS)], dtype=float), sums.get(-1, 0)


def latent_axes(weighted: np.ndarray, rank: int = LATENT) -> np.ndarray:
    """The leading right singular vectors, by subspace iteration from a fixed start."""
    rng = np.random.default_rng(7)
    rank = min(rank, *weighted.shape)
    basis = np.linalg.qr(rng.normal(size=(weighted.shape[1], min(rank + 16, *weighted.shape))))[0]
    for _ in range(6):
        basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
    _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
    return (basis @ right.T)[:, :rank].astype(np.float32)


def fit_quality(
    docs: DataFrame, labels: DataFrame, where: Column | None = None, label_col: str = "quality",
    most_rows: int = VOTERS,
) -> QualityVotes:
    """Term weights from all documents; latent axes and voting vectors from about ``most_rows`` labelled ones.

    ``where`` (on ``doc_id``) says which labels may be used. The driver gets the term
    counts of the sampled rows and one sum per bucket of terms. Without labels every
    score is one half.
    """
    found, size = document_frequencies(docs)
    idf = (np.log((size + 1) / (found + 1)) + 0.1).astype(np.float32)

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([zlib.compress(term_counts(text).tobytes(), 1) for text in texts.tolist()], dtype=object)

    sample = labelled_sample(docs, labels, label_col, most_rows, where)
    rows = sample.select("doc_id", "label", packed("text").alias("c")).orderBy("doc_id", "label").collect()
    if not rows:
        none = np.zeros((0, 1), dtype=np.float32)
        return QualityVotes(idf, np.zeros((TERMS, 1), dtype=np.float32), none, np.zeros(0), 0.5)
    counts = np.stack([np.frombuffer(zlib.decompress(row["c"]), dtype=np.float32) for row in rows])
    weighted = _weighted(counts, idf)
    axes = latent_axes(weighted)
    given = np.array([row["label"] for row in rows], dtype=float)
    return QualityVotes(idf, axes, _unit(weighted @ axes), given, float(given.mean()))


def score_quality(spark: SparkSession, docs: DataFrame, model: QualityVotes, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: more likely good) and ``predicted`` (1 from the cutoff on).

    Cosines with all broadcast vectors are computed for each whole text where it is read;
    the model has a fixed size. Null and empty texts get the share of good labels. Rows
    keep their other columns, repeated rows are scored each, an empty table stays empty.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.tolist()))

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    rows = docs.select(*kept, score(F.col(text_col)).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= CUTOFF).cast("int"))
