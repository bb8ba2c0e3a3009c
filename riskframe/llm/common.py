"""Helpers shared by the text operators: written intermediate tables and vectorised word hashing."""

from __future__ import annotations

import weakref

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import scratch_path


_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def settle(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it back: lineage ends there, lost executors cost nothing."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def release(spark: SparkSession, *settled: DataFrame) -> None:
    """Deletes settled tables that nothing reads any more; frames that ``settle`` did not make are left alone."""
    for df in settled:
        name = _paths.pop(df, None)
        if name:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Returns what Arrow keeps of finished batches: a worker lives on after its task and would hold it in other stages."""
    pa.default_memory_pool().release_unused()


#: A key of every row, whatever its id.
ROW = "__row"


def free_name(df: DataFrame) -> str:
    """A name for a row key that no column of ``df`` has, in whatever case."""
    name, taken = ROW, {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def with_row_keys(spark: SparkSession, df: DataFrame, name: str = ROW) -> DataFrame:
    """``df`` with a key for each row; written, so that a task that runs again sees the same keys."""
    return settle(spark, df.withColumn(name, F.monotonically_increasing_id()), "rows")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


# ---- words and shingles as 64-bit hashes -------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: near values become unrelated."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTE_CODES[_SPACE] = 0


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]), 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word, in order; words are runs without ASCII white space, A-Z in lower case."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    word = ~_SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(data))
    sums = np.add.reduceat(_BYTE_CODES[data] * up[:len(data)], starts)
    return mix(sums * down[starts])


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of ``size``-word shingles, sorted; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    width = min(size, len(words))
    count = len(words) - width + 1
    out = np.full(count, width if width < size else 0, dtype=np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(_BASE) + words[i:i + count])
    return np.unique(out)
