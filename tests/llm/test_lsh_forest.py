import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from riskframe.llm import lsh_forest
from riskframe.llm.components import components
from riskframe.llm.lsh_forest import drop_near_duplicates, near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*[words[i:] for i in range(size)], strict=False))


def brute_force(rows, size, percent):
    """Smallest id over links, by comparing all pairs."""
    sets = [shingles(text, size) for _, text in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            x, y = find(i), find(j)
            label[max(x, y)] = min(x, y)
    ids = {}
    for i, (key, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(key)
    return sorted((key, len(sets[i]), min(ids[find(i)])) for i, (key, _) in enumerate(rows))


def sample(seed, groups=8, copies=12, length=60):
    random.seed(seed)
    rows = []
    for _ in range(groups):
        base = [random.choice("abcdefghijklmnop") * random.randint(1, 4) for _ in range(length)]
        for _ in range(random.randint(1, copies)):
            text = list(base)
            for _ in range(random.choice([0, 1, 2, 3, 5])):
                text[random.randrange(length)] = str(random.random())
            rows.append(" ".join(text))
    rows += ["", None, "   \t", "one", "ONE", "one  two", "One\ntwo", "é É", "É é"]
    random.shuffle(rows)
    return [(i, text) for i, text in enumerate(rows)]


@pytest.mark.parametrize(("seed", "words"), [(1, 2), (2, 5)])
def test_groups_match_all_pairs(spark, seed, words):
    rows = sample(seed)
    got = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=words)
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect())
    assert got == brute_force(rows, words, 80)


def test_large_region_is_searched_whole(spark, monkeypatch):
    """A star: copies that are alike to one base only, more of them than neighbours are looked at."""
    monkeypatch.setattr(lsh_forest, "BLOCK_ROWS", 7)
    random.seed(5)
    base = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):
        text = list(base)
        for at in random.sample(range(100), 5):
            text[at] = f"x{i}_{at}"
        rows.append((i, " ".join(text)))
    got = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute_force(rows, 2, 80)


def test_repeated_ids_nulls_and_other_columns(spark):
    rows = [(3, "a b c", 1), (3, "a b c", 1), (None, "a b c", 2), (7, None, 3), (9, "a B c", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node int")
    got = near_duplicates(spark, docs, words=2)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == [
        ("3", 2, 3, True), ("3", 2, 3, True), ("7", 0, 7, True), ("9", 2, 3, False), ("None", 2, 3, False)]
    left = drop_near_duplicates(spark, docs, words=2)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 3, 7]


def test_rows_go_by_themselves_not_by_their_ids(spark):
    clean = "no other row is like this one"
    rows = [(1, "a b c d e f"), (None, "a b c d e f"), (None, clean), (None, None), (None, ""),
            (None, "x y z x y w"), (None, "x y z x y w"),
            (5, "p q r s t u"), (5, "a b c d e f"), (8, "p q r s t u"), (5, "k l m n o"), (2, "k l m n o"), (2, "k l M n o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = sorted(map(str, (tuple(r) for r in drop_near_duplicates(spark, docs, words=2).collect())))
    kept = [(1, "a b c d e f"), (None, clean), (None, None), (None, ""), (None, "x y z x y w"), (5, "p q r s t u")]
    # Equal ids with two spellings: one of them stays.
    assert [r for r in left if "(2," not in r] == sorted(map(str, kept))
    assert sum("(2," in r for r in left) == 1


def test_empty_table(spark):
    assert near_duplicates(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 50)] + [(60, 60), (None, 1)]
    got = components(spark, spark.createDataFrame(edges, "a long, b long"))
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert {roots[i] for i in range(100, 141)} == {100}
    assert {roots[i] for i in range(1, 50)} == {1}


def test_star_chain_and_null_ids_of_a_thousand_copies(spark):
    """Copies alike to one base only, a chain of small edits, and a third of the rows without an id."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1001):
        text = list(base)
        for at in rng.sample(range(0, 200, 2), 9):
            text[at] = f"x{i}_{at}"
        rows.append((i, " ".join(text)))
    chain = [f"c{i}" for i in range(200)]
    for i in range(2000, 3000):
        for at in rng.sample(range(200), 8):
            chain[at] = f"y{i}_{at}"
        rows.append((i, " ".join(chain)))
    second = rows[5][1].split()
    for i in range(4000, 4010):  # alike to one copy, not to the base
        text = list(second)
        for at in rng.sample(range(1, 200, 2), 9):
            text[at] = f"z{i}_{at}"
        rows.append((i, " ".join(text)))
    nulls = [(None, f"only null {i} " + " ".join(f"n{i}_{k}" for k in range(10))) for i in range(500)]
    rows += nulls + [(None, "the same text of rows without an id")] * 500 + [(2**60 + 1, "lone a b"), (2**60 + 2, "lone c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = {}
    for r in near_duplicates(spark, docs, words=2).collect():
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert sum(got[i] == {0} for i in range(1001)) >= 1000
    assert sum(got[i] == {0} for i in range(4000, 4010)) >= 9
    assert sum(got[i] == {2000} for i in range(2000, 3000)) >= 990
    assert got[2**60 + 1] == {2**60 + 1} and got[2**60 + 2] == {2**60 + 2} and got[None] == {None}
    left = drop_near_duplicates(spark, docs.withColumn("__row", F.lit("mine")), words=2)
    assert left.columns == ["doc_id", "text", "__row"]
    assert left.where("doc_id is null").count() == 501 and left.where("__row = 'mine'").count() == left.count()


def test_a_crowd_loses_no_link(spark):
    """Many texts alike, few of them enough: what links to one text only is found among all of its region."""
    rng = random.Random(3)
    base = [f"w{i}" for i in range(240)]
    rows = []
    for i in range(110):
        both = list(base)
        for at in rng.sample(range(0, 240, 2), 3):
            both[at] = f"x{i}_{at}"
        for twin in "yz":
            text = list(both)
            for at in rng.sample(range(1, 240, 2), 6):
                text[at] = f"{twin}{i}_{at}"
            rows.append(text)
    rng.shuffle(rows)
    rows = [(i, " ".join(text)) for i, text in enumerate(rows)]
    expected = brute_force(rows, 2, 80)
    assert 20 < len({c for _, _, c in expected}) < 220
    got = near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=2)
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == expected
