"""Hierarchical packing: documents routed to context sizes, windows filled up from shorter tiers, even step groups."""

from __future__ import annotations

import bisect
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import give_back
from riskframe.llm.tokens import word_ids

#: Context sizes, powers of two; the last is the longest sequence.
TIERS = (256, 512, 1024, 2048)
#: Tokens that wait in a task to be packed, at most, and those left waiting after a round of packing.
POOL_TOKENS, REST_TOKENS = 1 << 19, 1 << 17
#: Tokens of a step group: so many sequences of one tier make a step.
STEP_TOKENS = 16 * 2048

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
          "tier int, step_group long")
# Pieces as they leave a task.
_PACKED = PIECES.replace("doc_id long", "doc_id string")
_TYPES = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_SCHEMA = pa.schema([(name, _TYPES[kind]) for name, kind in map(str.split, _PACKED.split(", "))])


class _Packer:
    """Packs the pieces of one partition; a piece is (doc_id, ids, start, length, tokens of its document)."""

    def __init__(self, tiers: Sequence[int], partition: int):
        self.tiers, self.base = list(tiers), partition << 40
        self.pool: dict[int, list] = {}
        self.lengths: list[int] = []
        self.waiting = self.sequences = 0
        self.filled: dict[int, int] = {}
        self.rows: list[tuple] = []

    def _put(self, piece: tuple) -> None:
        length = piece[3]
        if length not in self.pool:
            self.pool[length] = []
            bisect.insort(self.lengths, length)
        self.pool[length].append(piece)
        self.waiting += length

    def _take(self, at: int) -> tuple:
        length = self.lengths[at]
        piece = self.pool[length].pop()
        if not self.pool[length]:
            del self.pool[length], self.lengths[at]
        self.waiting -= length
        return piece

    def _emit(self, pieces: list[tuple], tier: int) -> None:
        """One full sequence; steps of a tier hold equal numbers of its sequences."""
        number = self.filled.get(tier, 0)
        self.filled[tier] = number + 1
        step = self.base + (tier << 28) + number // max(1, STEP_TOKENS // tier)
        offset = 0
        for doc_id, ids, start, length, tokens in pieces:
            self.rows.append((doc_id, start, length, ids[4 * start:4 * (start + length)], tokens,
                              self.base + self.sequences, offset, tier, step))
            offset += length
        self.sequences += 1

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """Full windows of the longest tier leave at once, the rest waits for its tier."""
        tokens, longest, start = len(ids) // 4, self.tiers[-1], 0
        while tokens - start >= longest:
            self._emit([(doc_id, ids, start, longest, tokens)], longest)
            start += longest
        if start < tokens:
            self._put((doc_id, ids, start, tokens - start, tokens))

    def pack(self, until: int) -> None:
        """Longest first: a piece opens a window of its tier, whose gap takes the longest shorter pieces that fit."""
        while self.waiting > until:
            window = [self._take(len(self.lengths) - 1)]
            tier = next(t for t in self.tiers if t >= window[0][3])
            gap = tier - window[0][3]
            while gap and self.lengths:
                at = bisect.bisect_right(self.lengths, gap) - 1
                # If nothing fits whole, the shortest piece is cut and its rest waits on.
                doc_id, ids, start, length, tokens = self._take(max(at, 0))
                part = min(gap, length)
                window.append((doc_id, ids, start, part, tokens))
                if part < length:
                    self._put((doc_id, ids, start + part, length - part, tokens))
                gap -= part
            if gap:
                self._last(window, tier - gap)
            else:
                self._emit(window, tier)

    def _last(self, window: list[tuple], tokens: int) -> None:
        """The partition's last tokens go to sequences of falling powers of two, so they need no padding."""
        while tokens:
            size = 1 << (tokens.bit_length() - 1)
            tokens -= size
            taken, gap = [], size
            while gap:
                doc_id, ids, start, length, total = window.pop(0)
                part = min(gap, length)
                taken.append((doc_id, ids, start, part, total))
                if part < length:
                    window.insert(0, (doc_id, ids, start + part, length - part, total))
                gap -= part
            self._emit(taken, size)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 1, tiers: Sequence[int] = TIERS,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, tier, step_group``.

    A document is the ids of its text followed by ``end_id``; null and empty texts are
    that id alone. ``ids`` holds little-endian unsigned 32-bit values. Documents are
    routed by length: full windows of the longest tier are cut off, the rest goes to the
    smallest tier that holds it. Each window is filled to the last token, from whole
    shorter pieces as long as one fits, else by cutting the shortest. Only the last
    tokens of a partition make shorter sequences, of power-of-two lengths, so nothing is
    padded. A step group has the sequences of one tier that make up ``STEP_TOKENS``.

    Each scan partition is packed where it is read, without a shuffle, holding at most
    ``POOL_TOKENS`` waiting tokens besides the document at hand. Sequence ids are unique,
    not dense, and the same when a lost task runs again. Repeated rows are packed as often
    as they appear, null ids stay null, an empty table gives no pieces, other columns are
    ignored.
    """
    if list(tiers) != sorted(set(tiers)) or any(t < 1 or t & (t - 1) for t in tiers):
        raise ValueError("tiers must be rising powers of two")
    end = int(end_id).to_bytes(4, "little")
    sizes = list(tiers)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, encoder = _Packer(sizes, TaskContext.get().partitionId()), word_ids(tokenizer_path)

        def packed() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(cells, kind) for cells, kind in zip(columns, _SCHEMA.types, strict=True)], schema=_SCHEMA)

        for batch in batches:
            # Texts become Python objects a part at a time, since a batch of long ones is large.
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = encoder.encode(part.column("text").to_pylist())
                for key, ids in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    packer.add(key, ids + end)
                    if packer.waiting > POOL_TOKENS:
                        packer.pack(REST_TOKENS)
                if len(packer.rows) > 2000:
                    yield packed()
            batch = part = None
            give_back()
        packer.pack(0)
        if packer.rows:
            yield packed()
        give_back()

    # Ids pass through Python as text, whatever their type.
    source = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    pieces = source.mapInArrow(work, _PACKED)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))
