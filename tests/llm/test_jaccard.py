"""The n-gram Jaccard join against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from swinglake.llm import counts, jaccard
from swinglake.llm.components import components
from tests.llm.corpus import ROWS, awkward, nothing, words_of


def _sets(rows):
    for i, t in rows:
        w = words_of(t)
        yield i, frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def _brute(rows):
    """(id, set size, least id reachable), by comparing all pairs."""
    sets = list(_sets(rows))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            parent[root(a)] = root(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if s and i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return [(i, len(s), least.get(root(k)) if s else i) for k, (i, s) in enumerate(sets)]


def _corpus(n: int) -> list[tuple[int, str]]:
    """Families of edited copies, texts on both sides of the threshold, and a passage many share."""
    rnd, rows = random.Random(11), []
    passage = [f"p{i}" for i in range(30)]
    while len(rows) < n:
        base = [f"v{rnd.randrange(5000)}" for _ in range(rnd.randrange(3, 120))]
        if rnd.random() < .4:
            base[len(base) // 2:len(base) // 2] = passage
        for _ in range(rnd.choice([1, 1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 4])):
                copy[rnd.randrange(len(copy))] = f"e{rnd.randrange(9)}"
            rows.append((len(rows), " ".join(copy).upper() if rnd.random() < .1 else " ".join(copy)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece", [1000, 7])
def test_components_are_those_of_all_pairs(spark, monkeypatch, piece):
    monkeypatch.setattr(jaccard, "PIECE", piece)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 20_000)
    rows = _corpus(400)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, jaccard.near_duplicates(df).collect()))
    assert got == sorted(_brute(rows))
    assert len({c for *_, c in got}) < 0.7 * len(rows)
    kept = {r["doc_id"] for r in jaccard.one_of_each(df).collect()}
    assert kept == {c for *_, c in got}


def test_awkward_rows(spark):
    docs = awkward(spark)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(map(tuple, jaccard.near_duplicates(docs).collect()), key=key)
    assert got == sorted(_brute([(i, t) for i, t, _, _ in ROWS]), key=key)
    assert [r[2] for r in got if r[0] in (9, 10)] == [9, 9]
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "4", "5", "6", "8", "9", "None", "None"]
    assert jaccard.near_duplicates(nothing(spark)).count() == 0
    assert jaccard.one_of_each(nothing(spark)).count() == 0


def test_one_of_each_leaves_columns_alone(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (1, "a  b c", "y"), (2, "A B c", "z"), (3, "", "w"), (None, "a b c", "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string").withColumns(
        {c: F.col("_key") for c in ("_normal", "_id", "_copies", "content", "key")})
    kept = sorted(map(tuple, jaccard.one_of_each(docs).collect()))
    assert [r[0] for r in kept] == [1, 3] and all(set(r[2:]) == {r[2]} for r in kept) and kept[1][2] == "w"


def test_counts_beyond_32_bits(spark):
    """Two blocks with three thousand million of a key each; some buckets hold no key."""
    keys = jaccard.np.array([5, 1 << 63], dtype="u8")

    def block_keys(frame):
        return keys, jaccard.np.array([3_000_000_000, 1], dtype="i8")

    at = counts.Layout(2, 7)
    blocks = spark.createDataFrame([(0,), (1,)], "block int")
    counted = counts.totals(blocks, block_keys, at, lambda distinct, total: [int(total.sum())])
    frame = counted.toPandas()
    for block in (0, 1):
        assert counts.answers(frame[frame["block"] == block]).tolist() == [6_000_000_000, 2]
    assert counts.tallied(counted, 1) == [6_000_000_002]


def test_counts_are_small_and_tallies_are_read_without_them(spark):
    """A block is answered in less than two bytes a key where counts are low; tallies lie in a column of their own."""
    keys = jaccard.np.sort(jaccard.np.random.default_rng(2).integers(1, 1 << 63, 20_000).astype("u8") * 2)
    blocks = spark.createDataFrame([(i,) for i in range(3)], "block int")
    counted = counts.totals(blocks, lambda frame: (keys, jaccard.np.ones(len(keys), "i8")), counts.Layout(3, 2),
                            lambda distinct, total: [len(distinct), 2 ** 60]).localCheckpoint()
    frame = counted.where("block = 1").toPandas()
    assert sum(map(len, frame["totals"])) < 2 * len(keys)
    assert counts.answers(frame).tolist() == [3] * len(keys)
    assert counts.tallied(counted.drop("totals"), 2) == [len(keys), 2 ** 61]


def test_bounds_never_lose_a_pair():
    rnd = random.Random(4)
    base = [rnd.getrandbits(64) for _ in range(300)]
    sets = [jaccard.np.array(sorted({x for x in base if rnd.random() < share}), dtype="u8")
            for share in (.99, .97, .9, .8, .5) for _ in range(40)]
    forest = jaccard.Forest(list(range(len(sets))))
    jaccard.tree_join(sets, forest, list(range(len(sets))))
    plain = jaccard.Forest(list(range(len(sets))))
    for a, b in combinations(range(len(sets)), 2):
        if jaccard.linked(sets[a], sets[b]):
            plain.unite(a, b)
    assert [forest.root(i) for i in range(len(sets))] == [plain.root(i) for i in range(len(sets))]


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("u"),
                                       F.lpad((F.col("id") - 1).cast("string"), 4, "0").alias("v"))
    got = components(edges.union(spark.createDataFrame([("x", "y"), ("y", "z"), ("q", "q")], "u string, v string")))
    by = {r["node"]: r["component"] for r in got.collect()}
    assert {by[f"{i:04d}"] for i in range(300)} == {"0000"} and by["z"] == by["y"] == by["x"] == "x"
