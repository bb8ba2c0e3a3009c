"""Language ID as mixture inference: EM over n-gram likelihoods gives each document's language proportions."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hash buckets of letter trigrams; with the languages they fix the size of the model.
BUCKETS = 1 << 15
#: Languages the model may hold; more distinct training labels are refused, not cut.
MOST_LANGUAGES = 400
#: Added to each bucket's count, in trigrams.
SMOOTHING = 0.05
ROUNDS, TOLERANCE = 25, 1e-3
#: Half the log of the text's trigrams, times this, is what a further language must gain.
PENALTY = 4.0
UNKNOWN = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the letter trigrams of a text in lower case, and their counts; words are padded by one gap."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes] if len(codes) else np.zeros(0, dtype=bool)
    if not letter.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    codes = np.where(letter, codes, 0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.r_[0, codes[keep], 0].astype(np.uint64)
    mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:]
    mixed = (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(49)
    counts = np.bincount(mixed[codes[1:-1] > 0].astype(np.int64), minlength=BUCKETS)
    grams = np.flatnonzero(counts)
    return grams, counts[grams].astype(np.float64)


def fit_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """The sorted languages and their trigram likelihoods (buckets by languages) from all rows with a language.

    Counts are summed inside each task, then by Spark; the driver gets at most
    ``BUCKETS`` numbers for each language. Null languages and texts teach nothing. More
    than ``MOST_LANGUAGES`` languages are an error.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch["text"].tolist(), batch["lang"].tolist(), strict=True):
                grams, counts = trigrams(text)
                if len(grams):
                    if lang not in sums and len(sums) >= MOST_LANGUAGES:
                        raise ValueError(f"more than {MOST_LANGUAGES} languages")
                    sums.setdefault(lang, np.zeros(BUCKETS))[grams] += counts
        for lang, total in sums.items():
            grams = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "gram": grams, "n": total[grams].astype(np.int64)})

    partial = rows.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).mapInPandas(
        count, "lang string, gram int, n long")
    by_lang = partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(by_lang["lang"].unique().tolist())
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    table = np.full((BUCKETS, len(langs)), SMOOTHING)
    column = {lang: i for i, lang in enumerate(langs)}
    np.add.at(table, (by_lang["gram"].to_numpy(), by_lang["lang"].map(column).to_numpy(dtype=int)),
              by_lang["n"].to_numpy(dtype=float))
    return langs, (table / table.sum(axis=0, keepdims=True)).astype(np.float32)


def proportions(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """EM: mixture proportions of the columns of ``likelihood``, and the log-likelihood of the counts."""
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    total = counts.sum()
    for _ in range(ROUNDS):
        joint = likelihood @ share
        updated = share * (likelihood.T @ (counts / joint)) / total
        moved = np.abs(updated - share).max()
        share = updated
        if moved < TOLERANCE:
            break
    share = share / share.sum()
    return share, float(counts @ np.log(likelihood @ share))


def infer(text: str | None, langs: list[str], table: np.ndarray) -> tuple[str, float, list[str], list[float]]:
    """The main language, its proportion, and all languages of the chosen set with theirs.

    Languages join in the order of their proportions in the full mixture; a set is kept
    while the log-likelihood, less the penalty for each further language, goes up.
    """
    grams, counts = trigrams(text)
    if not len(grams) or not langs:
        return UNKNOWN, 0.0, [], []
    likelihood = table[grams].astype(np.float64)
    share, _ = proportions(likelihood, counts)
    order = np.argsort(-share, kind="stable")
    # The best single language need not have the largest proportion.
    singles = counts @ np.log(likelihood)
    chosen, best = np.array([int(np.argmax(singles))]), float(singles.max())
    chosen_share = np.ones(1)
    price = PENALTY * 0.5 * np.log(counts.sum() + 1)
    for size in range(2, len(langs) + 1):
        if share[order[size - 1]] < TOLERANCE:
            break
        some = order[:size]
        part, fit = proportions(likelihood[:, some], counts)
        if fit - price * (size - 1) <= best:
            break
        chosen, chosen_share, best = some, part, fit - price * (size - 1)
    ranked = np.argsort(-chosen_share, kind="stable")
    names = [langs[chosen[i]] for i in ranked]
    shares = [float(min(1.0, chosen_share[i])) for i in ranked]
    return names[0], shares[0], names, shares


def predict_languages(
    spark: SparkSession, docs: DataFrame, langs: list[str], table: np.ndarray, text_col: str = "text",
) -> DataFrame:
    """Adds ``lang_pred, score, languages, proportions`` to ``docs``; only the text is looked at.

    Each text is read whole where it lies, against the broadcast model, whose size is
    fixed (buckets by languages). Null texts, texts without a letter, and all texts of a
    model without languages are ``und`` with score 0. Rows keep their other columns;
    repeated rows are predicted each; an empty table stays empty.
    """
    model = spark.sparkContext.broadcast((langs, table))

    @F.pandas_udf("lang_pred string, score double, languages array<string>, proportions array<double>")
    def inferred(texts: pd.Series) -> pd.DataFrame:
        names, likelihood = model.value
        found = [infer(text, names, likelihood) for text in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score", "languages", "proportions"])

    names = ["lang_pred", "score", "languages", "proportions"]
    kept: list[Column] = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    rows = docs.select(*kept, inferred(F.col(text_col)).alias("__found"))
    return rows.select(*kept, *[F.col(f"__found.{name}").alias(name) for name in names])
