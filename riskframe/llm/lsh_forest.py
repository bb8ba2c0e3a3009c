"""MinHash near-duplicates: an LSH forest of sorted signature orders, links confirmed on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.llm.common import free_name, mix, release, settle, shingle_hashes, with_row_keys, word_hashes
from riskframe.llm.components import components

#: Values of a signature (2 bytes each), sorted orders (trees), and values of a sort key. Each order
#: starts ``STEP`` values after the one before.
VALUES, ORDERS, STEP, KEY_VALUES = 128, 24, 5, 12
#: Values that two neighbours must share at least, and values that a region shares. Regions are searched whole, and two
#: sets of similarity 0.8 share none of the 24 regions three times in a million.
LEAST_DEPTH, REGION_DEPTH = 3, 4
#: Neighbours looked at on either side; regions with more members than that and one are searched again as a whole.
REACH = 3
#: Bits of the 128-bit sketches on which a candidate agrees; at similarity 0.8 fewer agree once in a million times.
LEAST_AGREEING = 98
#: Bits that tell how far two sets differ at least.
PARITY_BITS = 1024
#: Members of a region on either side of a comparison in one task, and partners that a member has confirmed in the
#: first round; the rounds go on, each with ``MORE`` times as many, until no partner is left.
BLOCK_ROWS, PARTNERS, MORE = 4096, 256, 64

_SEEDS = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_CHUNK = 4096


def least_values(shingles: np.ndarray) -> np.ndarray:
    """For each of the hash functions the smallest value over the shingles."""
    least = np.full(VALUES, 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        part = (shingles[i:i + _CHUNK, None] * _SEEDS[None, :]) >> np.uint64(32)
        least = np.minimum(least, part.min(axis=0))
    return least


def signature(shingles: np.ndarray) -> tuple[bytes, bytes]:
    """The low 2 bytes of the smallest values, and a sketch of one bit of each."""
    low = mix(least_values(shingles)) & np.uint64(0xFFFF)
    return low.astype(">u2").tobytes(), np.packbits((low & np.uint64(1)).astype(bool)).tobytes()


def parity(shingles: np.ndarray) -> bytes:
    """For each bit whether an odd number of shingles falls on it: two sets differ in as many shingles as bits at least."""
    counts = np.bincount((shingles % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits(counts & 1 == 1).tobytes()


def shingle_features(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """``doc_id, said, node, n, sig, sketch``: ``node`` names the shingle set, so equal sets share it; null without words.

    Ids stay in the JVM; ``said`` is a hash of the text that finds a node's text again.
    """
    @F.pandas_udf("node binary, n long, sig binary, sketch binary")
    def features(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts.tolist():
            shingles = shingle_hashes(word_hashes(text), words)
            if len(shingles):
                name = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                out.append((name, len(shingles), *signature(shingles)))
            else:
                out.append((None, 0, None, None))
        return pd.DataFrame(out, columns=["node", "n", "sig", "sketch"])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("said"),
                         features(F.col(text_col)).alias("f"))
    return source.select("doc_id", "said", "f.*")


# ---- sorted orders -----------------------------------------------------------------------------


def _orders(nodes: DataFrame) -> DataFrame:
    """One row per node and order; the key is the order and the signature values it starts with."""
    twice = F.concat("sig", "sig")
    keys = F.array(*[
        F.concat(F.lit(bytearray([i])), F.substring(twice, 2 * STEP * i + 1, 2 * KEY_VALUES)) for i in range(ORDERS)])
    return nodes.select(F.explode(keys).alias("key"), "node", "n", "sketch")


_SCAN = "a binary, b binary, key binary, node binary, n long, sketch binary, region binary"


def _table(cells: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(cells.tolist()), dtype=np.uint8).reshape(-1, width)


def _neighbours(percent: int, width: int, shared: int, crowd: int, edges: bool = True):
    """Scans sorted rows: candidate pairs, members of crowded regions, and the rows at both ends of the partition.

    Keys have ``width`` bytes. Each row is compared with the ``REACH`` rows before it, those of the longest
    common prefixes: where rows lie dense these share many values, where they are sparse few, ``shared`` bytes at least.
    Sizes and sketches tell which of them can be alike enough. Rows that share ``crowd`` bytes are one region. One of
    up to ``REACH + 1`` rows is compared whole here; of a larger, crowded one only the nearest rows are, and all its
    members are given back for ``_rest_of_regions``.
    """
    def pairs_of(rows: pd.DataFrame, fresh: int) -> pd.DataFrame:
        node, n = rows["node"].to_numpy(object), rows["n"].to_numpy()
        key, sketch = _table(rows["key"], width), _table(rows["sketch"], VALUES // 8).view(np.uint64)
        left, right = [], []
        for step in range(1, REACH + 1):
            later = np.arange(max(fresh, step), len(rows))
            earlier = later - step
            hit = (key[later, :shared] == key[earlier, :shared]).all(axis=1)
            if step > 1:
                first = np.maximum(later - REACH - 1, 0)
                hit &= (key[later, :crowd] != key[first, :crowd]).any(axis=1) | (later <= REACH)
            hit &= 100 * np.minimum(n[later], n[earlier]) >= percent * np.maximum(n[later], n[earlier])
            later, earlier = later[hit], earlier[hit]
            apart = np.bitwise_count(sketch[later] ^ sketch[earlier]).sum(axis=1, dtype=np.int64)
            near = apart <= VALUES - LEAST_AGREEING
            left.append(node[earlier[near]])
            right.append(node[later[near]])
        x, y = np.concatenate(left), np.concatenate(right)
        swap = np.array([p > q for p, q in zip(x, y, strict=True)], dtype=bool)
        out = pd.DataFrame({"a": np.where(swap, y, x), "b": np.where(swap, x, y)})
        return out[out["a"] != out["b"]].drop_duplicates()

    def members_of(batch: pd.DataFrame) -> pd.DataFrame:
        """Members of regions that are crowded, or may be as they touch an end of the batch."""
        key = _table(batch["key"], width)[:, :crowd]
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(key)])
        open_ = sizes > REACH + 1
        open_[0] = open_[-1] = True
        chosen = batch[np.repeat(open_, sizes)]
        return chosen.assign(region=[k[:crowd] for k in chosen["key"]], key=None)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def padded(frame: pd.DataFrame) -> pd.DataFrame:
            return frame.reindex(columns=["a", "b", "key", "node", "n", "sketch", "region"])

        held, head = None, 0
        for batch in batches:
            if not len(batch):
                continue
            if head < REACH and edges:
                first = batch.head(REACH - head)
                head += len(first)
                yield padded(first)
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            yield padded(pairs_of(rows, len(rows) - len(batch)))
            if edges:
                yield padded(members_of(batch))
            held = rows.tail(REACH + 1)
        if held is not None and edges:
            yield padded(held.tail(REACH))

    return work


def _scanned(spark: SparkSession, rows: DataFrame, *options) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs and region members of rows (``key, node, n, sketch``) sorted by key over all partitions."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["key", "node", "n", "sketch"]
    rows = rows.select(columns).repartitionByRange(parts, "key").sortWithinPartitions("key")
    scan = settle(spark, rows.mapInPandas(_neighbours(*options), _SCAN), "neighbours")
    # At most 2 * REACH rows a partition, scanned over the partitions' ends.
    ends = scan.where("key is not null").select(columns).distinct()
    across = ends.coalesce(1).sortWithinPartitions("key").mapInPandas(_neighbours(*options, False), _SCAN)
    pairs = scan.where("a is not null").select("a", "b").union(across.select("a", "b")).distinct()
    pairs = settle(spark, pairs, "pairs")
    members = settle(spark, scan.where("region is not null").select("region", "node", "n", "sketch"), "members")
    release(spark, scan)
    return pairs, members


# ---- full sets ---------------------------------------------------------------------------------


def _confirmed(percent: int):
    """Keeps the pairs whose full sets are alike enough."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["set_a"].tolist(), batch["set_b"].tolist(), strict=True):
                p, q = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                common = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.loc[keep, ["a", "b"]]

    return work


def _links(spark: SparkSession, pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    linked = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    linked = linked.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    return settle(spark, linked.mapInPandas(_confirmed(percent), "a binary, b binary"), "links")


def _shingle_sets(docs: DataFrame, id_col: str, text_col: str, words: int, wanted: DataFrame) -> DataFrame:
    """``node, set, parity`` for the nodes of ``wanted`` (node, doc_id, said): computed again from one text each."""
    @F.pandas_udf("set binary, parity binary")
    def shingle_set(texts: pd.Series) -> pd.DataFrame:
        sets = [shingle_hashes(word_hashes(text), words) for text in texts.tolist()]
        return pd.DataFrame({"set": [s.tobytes() for s in sets], "parity": [parity(s) for s in sets]}, dtype=object)

    def keys(table: DataFrame, key: str, said: Column, *more: str) -> DataFrame:
        key = F.col(key).cast("long")
        return table.select(said.alias("said"), key.isNull().alias("unnamed"), F.coalesce(key, F.lit(0)).alias("key"), *more)

    source = keys(docs.withColumn("__text", F.col(text_col)), id_col, F.xxhash64(text_col), "__text")
    names = ["said", "unnamed", "key"]
    found = source.join(keys(wanted, "doc_id", F.col("said"), "node"), names)
    # Rows that repeat an id and text give the same set, one of them is enough.
    found = found.groupBy(*names, "node").agg(F.first("__text").alias("text"))
    return found.select("node", shingle_set("text").alias("s")).select("node", "s.*")


# ---- crowded regions -----------------------------------------------------------------------------


def _partners(percent: int, limit: int):
    """Compares the probes of each region with its residents, row by row: the ``limit`` nearest partners of each probe.

    Partners have another root, and sizes, sketches and parities that allow a link. ``more`` marks probes with more of them.
    """
    names = ["region", "probes", "residents"]

    def partners(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        probe = rows["probe"].to_numpy(bool)
        p_rows, r_rows = np.flatnonzero(probe), np.flatnonzero(~probe)
        node, n = rows["node"].to_numpy(object), rows["n"].to_numpy()
        root = pd.factorize(rows["root"])[0]
        sketch, odd = (_table(rows[c], w // 8).view(np.uint64) for c, w in (("sketch", VALUES), ("parity", PARITY_BITS)))
        for start in range(0, len(p_rows), 128):
            p = p_rows[start:start + 128]
            apart = np.bitwise_count(sketch[p][:, None] ^ sketch[r_rows][None]).sum(axis=2, dtype=np.int64)
            near = (apart <= VALUES - LEAST_AGREEING) & (root[p][:, None] != root[r_rows][None])
            small, large = np.minimum(n[p][:, None], n[r_rows]), np.maximum(n[p][:, None], n[r_rows])
            at, to = np.nonzero(near & (100 * small >= percent * large))
            x, y = p[at], r_rows[to]
            differ = np.concatenate([np.zeros(0, dtype=np.int64)] + [
                np.bitwise_count(odd[x[i:i + _CHUNK]] ^ odd[y[i:i + _CHUNK]]).sum(axis=1, dtype=np.int64)
                for i in range(0, len(x), _CHUNK)])
            can = 100 * (n[x] + n[y] - differ) >= percent * (n[x] + n[y] + differ)
            x, y, differ = x[can], y[can], differ[can]
            order = np.lexsort((differ, x))
            x, y = x[order], y[order]
            rank = np.arange(len(x)) - np.searchsorted(x, x)
            total = np.searchsorted(x, x, "right") - np.searchsorted(x, x)
            keep = rank < limit
            pairs = [(min(a, b), max(a, b)) for a, b in zip(node[x[keep]], node[y[keep]], strict=True)]
            yield pd.DataFrame(pairs, columns=["a", "b"]).assign(more=total[keep] > limit)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(rows):
                continue
            group = rows.groupby(names, sort=False).ngroup().to_numpy()
            stops = np.flatnonzero(np.r_[group[1:] != group[:-1], True]) + 1
            starts = np.r_[0, stops[:-1]]
            for start, stop in zip(starts[:-1].tolist(), stops[:-1].tolist(), strict=True):
                yield from partners(rows.iloc[start:stop])
            held = rows.iloc[starts[-1]:]
        if held is not None:
            yield from partners(held)

    return work


def _open_regions(spark: SparkSession, members: DataFrame, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of regions with several roots: their root, that of most members, and the blocks of both sides."""
    roots = labels.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
    rows = members.select("region", "node", "n", "sketch").join(sets.select("node", "parity"), "node")
    rows = rows.join(roots, F.col("node") == F.col("__node"), "left").select(
        "region", "node", "n", "sketch", "parity", F.coalesce("__root", "node").alias("root")).repartition("region")
    region = Window.partitionBy("region")
    rows = rows.withColumn("most", F.struct(F.count(F.lit(1)).over(Window.partitionBy("region", "root")), "root"))
    rows = rows.withColumn("main", F.max("most").over(region)["root"])
    rows = rows.withColumn("others", F.count(F.when(F.col("root") != F.col("main"), 1)).over(region))
    rows = rows.withColumn("all", F.count(F.lit(1)).over(region)).where("others > 0")
    blocks = [F.ceil(F.col(c) / BLOCK_ROWS).cast("int").alias(name) for c, name in (("others", "p"), ("all", "r"))]
    return settle(spark, rows.select("region", "node", "n", "sketch", "parity", "root", "main", *blocks), "open")


def _rest_of_regions(
    spark: SparkSession, rows: DataFrame, sets: DataFrame, percent: int, limit: int,
) -> tuple[DataFrame, bool]:
    """Links between components inside open regions, and whether that is all of them.

    A link inside a component changes nothing, so members of a region's most frequent root are only compared with the
    others, and these with all members. Both sides are dealt in blocks, each pair of blocks to one task.
    """
    def dealt(side: DataFrame, probe: bool) -> DataFrame:
        own, other = ("p", "r") if probe else ("r", "p")
        own = F.pmod(F.hash("node"), F.col(own))
        other = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return side.select("region", (own if probe else other).alias("probes"), (other if probe else own).alias("residents"),
                           F.lit(probe).alias("probe"), "node", "n", "root", "sketch", "parity")

    keys = ["region", "probes", "residents"]
    stream = dealt(rows.where("root <> main"), True).union(dealt(rows, False))
    stream = stream.repartition(*keys).sortWithinPartitions(*keys)
    found = stream.mapInPandas(_partners(percent, limit), "a binary, b binary, more boolean")
    found = settle(spark, found.groupBy("a", "b").agg(F.max("more").alias("more")), "partners")
    linked = _links(spark, found.select("a", "b"), sets, percent)
    whole = found.where("more").isEmpty()
    release(spark, found)
    return linked, whole


def _joined(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, root) after ``links`` between their components; nodes without a label are their own root."""
    ends = links
    for end in ("a", "b"):
        names = labels.select(F.col("node").alias("__node"), F.col("root").alias("__root"))
        ends = ends.join(names, F.col(end) == F.col("__node"), "left").withColumn(
            f"root_{end}", F.coalesce("__root", end)).drop("__node", "__root")
    ends = settle(spark, ends, "ends")
    again = components(spark, ends.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    names = again.select(F.col("node").alias("__r"), F.col("root").alias("__root"))
    known = labels.union(ends.select("a", "root_a")).union(ends.select("b", "root_b")).distinct()
    out = settle(spark, known.join(names, F.col("root") == F.col("__r"), "left").select(
        "node", F.coalesce("__root", "root").alias("root")), "labels")
    release(spark, labels, ends, again)
    return out


def near_duplicates(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    words: int = 5, percent: int = 80,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``.

    Texts with equal sets of ``words``-word shingles are one node. Nodes are sorted by
    their signatures in several orders. Sorted neighbours, the nodes of the longest common prefixes, are
    candidates, so depth follows the density of each region by itself: it is long where nodes lie
    dense and falls to ``LEAST_DEPTH`` values where they are sparse. Candidates are links when
    ``100 * |intersection| >= percent * |union|`` of their full sets. Nodes that share ``REGION_DEPTH`` values are
    a region. If it has more members than neighbours are looked at and the links leave it in several components, all
    its pairs between these are compared: see ``_rest_of_regions``. Rounds go on until no such pair is left
    unconfirmed, so no number of members, partners or rounds is a limit.
    ``component_id`` is the smallest id reachable over links, ``kept`` marks its row.

    Null, empty and blank texts have no shingles, are linked with nothing and kept.
    Repeated rows share a component; of rows with the same id all are ``kept`` together.
    A null id counts as larger than any other. Other columns are ignored. An empty table
    gives an empty result.
    """
    feats = settle(spark, shingle_features(docs, id_col, text_col, words), "signatures")
    nodes = feats.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "said")).alias("first"),
        F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"))
    nodes = settle(spark, nodes.select("node", "first.doc_id", "first.said", "n", "sig", "sketch"), "nodes")

    pairs, members = _scanned(spark, _orders(nodes), percent, 1 + 2 * KEY_VALUES, 1 + 2 * LEAST_DEPTH,
                              1 + 2 * REGION_DEPTH)
    crowd = members.withColumn("members", F.count(F.lit(1)).over(Window.partitionBy("region")))
    crowd = settle(spark, crowd.where(F.col("members") > REACH + 1).drop("members"), "crowd")
    release(spark, members)
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowd.select("node")).distinct()
    texts = nodes.select("node", "doc_id", "said").join(wanted, "node")
    sets = settle(spark, _shingle_sets(docs, id_col, text_col, words, texts), "sets")

    links = _links(spark, pairs, sets, percent)
    labels = components(spark, links)
    release(spark, pairs, links)
    crowd, closed = _open_regions(spark, crowd, sets, labels), crowd
    release(spark, closed)
    limit, whole = PARTNERS, crowd.isEmpty()
    while not whole:
        links, whole = _rest_of_regions(spark, crowd, sets, percent, limit)
        if not links.isEmpty():
            labels = _joined(spark, labels, links)
            if not whole:
                crowd, closed = _open_regions(spark, crowd, sets, labels), crowd
                release(spark, closed)
                whole = crowd.isEmpty()
        release(spark, links)
        limit *= MORE

    named = nodes.select("node", "doc_id").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = settle(spark, named.join(least, "root").select(F.col("node").alias("__node"), "component_id"), "named")
    release(spark, sets, crowd, labels)
    out = feats.select("doc_id", "node", "n").join(named, F.col("node") == F.col("__node"), "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their group, chosen row by row.

    A group is stood for by its row of the smallest id (a null id counts as larger than any other), then of
    the smallest hash of the text. Rows that repeat this id and text stay with it, but a null id names
    no document: only one such row stays. Other rows with that id go by their own groups. Rows without
    words all stay.
    """
    key = free_name(docs)
    rows = with_row_keys(spark, docs, key)
    found = near_duplicates(spark, rows, id_col=key, words=words, percent=percent)
    found = found.select(F.col("doc_id").alias("__found"), F.col("component_id").alias("__group"))
    own = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").cast("long").alias("id"),
                   F.sha2("text", 256).alias("hash"), F.when(F.col("doc_id").isNull(), F.col(key)).alias("row"))
    grouped = rows.select(F.col(key).alias("__key"), own.alias("__own")).join(
        found, F.col("__key") == F.col("__found")).select("__key", "__own", "__group")
    grouped = settle(spark, grouped, "groups")
    first = grouped.groupBy("__group").agg(F.min("__own").alias("__first"), F.count(F.lit(1)).alias("__n"))
    first = first.where("__n > 1").drop("__n")
    gone = grouped.join(first, "__group").where(~F.col("__own").eqNullSafe(F.col("__first")))
    return rows.join(gone.select(F.col("__key").alias(key)), key, "left_anti").drop(key)
