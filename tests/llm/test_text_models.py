"""Toxicity, language model and benchmark decontamination."""

from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from swinglake.llm import decontamination as dc
from swinglake.llm import lm, toxicity
from tests.llm.corpus import ROWS, awkward, nothing, words_of

SF_DIR = "/root/testdata/sf0.01"


def _toy(n: int) -> list[tuple[int, str, int, int]]:
    rnd, rows = random.Random(5), []
    for i in range(n):
        words = [f"w{rnd.randrange(300)}" for _ in range(40)]
        junk, toxic = rnd.random() < .3, rnd.random() < .25
        if junk:
            words.insert(rnd.randrange(40), "%%% zzjunk" + "abc"[i % 3])
        if toxic:
            words.insert(rnd.randrange(40), "grumble" + rnd.choice(["st", "r", "ns", "xyz"]))
        rows.append((i, " ".join(words), int(not junk), int(toxic)))
    return rows


def test_chain_finds_held_out_toxic_texts(spark):
    rows = _toy(1500)
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")
    chain = toxicity.fit_chain(df.select("doc_id", "text"), df.where("doc_id < 1000").drop("text"), toxicity.label_categories())
    assert chain.names == ["low_quality", "toxic", "toxic_junk"] and [len(e) for e in chain.earlier] == [0, 1, 2]
    got = {r["doc_id"]: r for r in toxicity.scores(df, chain).collect()}
    for i, _, quality, toxic in rows[1000:]:
        assert (got[i]["p_toxic"] >= 0.5) == bool(toxic)
        assert (got[i]["p_low_quality"] >= 0.5) == (not quality)
    kept = {r["doc_id"] for r in toxicity.without_toxic(df, chain).collect()}
    assert kept == {i for i, *_ in rows if got[i]["p_toxic"] < 0.5}


def test_labels_that_teach_nothing(spark):
    docs = awkward(spark)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none = toxicity.fit_chain(docs, labels, toxicity.label_categories())
    got = toxicity.scores(docs, none).collect()
    assert len(got) == len(ROWS) and all(r["p_toxic"] < 1e-9 for r in got)
    one = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit_chain(docs, one, toxicity.label_categories())
    kept = toxicity.without_toxic(docs, chain)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert toxicity.without_toxic(nothing(spark), chain).count() == 0


def _model(rows, order):
    """Brute force: counts of all orders over training texts, and P(w|h) by recursion."""
    texts = [tuple([*words_of(t), "\0"]) for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = [Counter(t[i:i + m] for t, h in zip(texts, held) if not h for i in range(len(t) - m + 1))
              for m in range(1, order + 1)]
    n, v = sum(counts[0].values()), len(counts[0])
    b = [min(max(sum(c == 1 for c in k.values()) / max(sum(k.values()), 1), .01), .99) for k in counts]

    def p(h, w):
        if not h:
            return (counts[0][(w,)] + 1) / (n + v + 1)
        seen, low = counts[len(h) - 1][h], p(h[1:], w)
        if not seen:
            return low
        x = b[len(h)] + .8 * (1 - b[len(h)]) / seen ** 2
        return (1 - x) * counts[len(h)][h + (w,)] / seen + x * low

    for (i, _), t, h in zip(rows, texts, held):
        yield (i, h, len(t), sum(counts[0][(w,)] > 0 for w in t), n, sum(math.log10(p((), w)) for w in t),
               sum(math.log10(p(t[max(0, k - order + 1):k], t[k])) for k in range(len(t))))


@pytest.mark.parametrize("order", [2, 3])
def test_automaton_agrees_with_the_model(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choice("abcdefgh") + "x" * rnd.randrange(3) for _ in range(rnd.randrange(60)))) for i in range(150)]
    rows += [(i, t) for i, t, _, _ in ROWS]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("mine"))
    got = sorted(map(tuple, lm.scores(df, order).collect()), key=str)
    want = sorted(_model(rows, order), key=str)
    assert len(got) == len(want)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    assert lm.scores(nothing(spark)).count() == 0


def test_counts_of_the_model_come_in_ranges_of_keys(spark, monkeypatch):
    """Each range of keys is counted apart, texts are packed once and no range has another's buckets."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 3000)
    monkeypatch.setattr("swinglake.llm.counts.BUCKET_KEYS", 500)
    kept, keep = [], lm.staged
    monkeypatch.setattr(lm, "staged", lambda df, name: kept.append((name, keep(df, name))) or kept[-1][1])
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 97}" for j in range(80))) for i in range(120)] + [(None, None), (7, " \t")]
    got = lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [name for name, _ in kept] == ["packed-texts"] + ["ngram-counts"] * lm.PARTS
    texts = kept[0][1]
    assert texts.count() == texts.select("block").distinct().count() > 1
    buckets = [{r[0] for r in t.select("bucket").distinct().collect()} for _, t in kept[1:]]
    assert all(buckets) and len(set().union(*buckets)) == sum(map(len, buckets))
    assert all(max(a) < min(b) for a, b in zip(buckets, buckets[1:]))
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(_model(rows, 3), key=key), strict=True):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)


def test_memory_of_scoring_a_block():
    """Numbers of 32 bits, keys sorted in pieces and dropped, arrays freed: at most 180 bytes a token at once."""
    rnd = np.random.default_rng(6)
    texts = [" ".join(f"w{int(w)}" for w in rnd.zipf(1.3, 400) % 50_000) for _ in range(500)]
    packed = lm._pack(pa.table({"doc_id": pa.array(range(500), pa.int64()), "normal": texts,
                                "held_out": [i % 7 == 2 for i in range(500)], "block": pa.array([0] * 500, pa.int32())}))
    parts = [packed[p][0].as_py() for p in ("held", "lengths", "kinds", "numbers")]
    total = np.concatenate([lm.Block(*parts, 3).distinct(i, lm.PARTS)[1] for i in range(lm.PARTS)])
    tracemalloc.start()
    try:
        block = lm.Block(*parts, 3)
        block.count(total)
        read = lm.Automaton(block, 3, [.3, .4, .5], 10 ** 6, 10 ** 5).read(block.first, block.lengths)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(read) == 500 and (read < 0).all()
    assert peak < 180 * block.lengths.sum()


def test_registered_model_backs_off_more_than_once(spark):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice("abcd") for _ in range(30))) for i in range(60)]
    got = {r["doc_id"]: r["score"] for r in lm.scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == pytest.approx({w[0]: w[6] for w in _model(rows, 3)}, rel=1e-9)


def test_model_beats_its_base_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    base, score = lm.scores(docs).where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert score > base


def test_search_finds_all_items_above_the_threshold():
    rnd = random.Random(1)
    items = [(i, *dc.split_item([f"t{int(rnd.expovariate(.02))}" for _ in range(rnd.randrange(4, 30))])) for i in range(120)]
    index = dc.Index(items)
    for threshold in (.2, .5, .8):
        for _ in range(60):
            passage = {f"t{int(rnd.expovariate(.03))}" for _ in range(40)} | set(rnd.choice(items)[1])
            terms = sorted(index.terms[w] for w in passage if w in index.terms)
            scores = Counter()
            for t in terms:
                for item, x in index.postings[t]:
                    scores[item] += x
            found = dict(dc.search(index, terms, threshold))
            assert set(found) == {i for i, x in scores.items() if x >= threshold - 1e-9}
            assert all(abs(scores[i] - x) < 1e-9 for i, x in found.items())


def test_every_document_that_holds_an_item_is_found(spark):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    normal = {r["item_id"]: " " + " ".join(dc._words(r["text"].lower())) + " " for r in items.collect()}
    want = set()
    for r in docs.collect():
        text = " " + " ".join(dc._words((r["text"] or "").lower())) + " "
        want |= {(r["doc_id"], i) for i, t in normal.items() if t in text}
    got = {(r["doc_id"], r["item_id"]) for r in dc.contamination(docs, items).collect()}
    assert want and got == want
    clean = dc.without_contaminated(docs, items)
    assert clean.schema == docs.schema
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - {d for d, _ in want}


def test_edited_and_truncated_items_are_found(spark):
    texts = [" ".join(f"q{i}w{k}" for k in range(16 + 8 * (i % 3))) for i in range(9)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows, want = [], set()
    for i, t in enumerate(texts):
        words = t.split()
        copies = [words[:-(len(words) // 4)]]                             # without its last quarter
        copies += [words[:at] + ["other"] + words[at + 1:] for at in range(len(words))]
        if len(words) >= 32:
            copies += [[("other" if k in (3, 14, 29) else w) for k, w in enumerate(words)]]
        copies += [[("other" if k in (0, len(words) - 2) else w) for k, w in enumerate(words)]]
        for c in copies:
            want.add((len(rows), i))
            rows.append((len(rows), " ".join(["before", *c, "after"])))
    docs = spark.createDataFrame([*rows, (len(rows), "nothing of any item")], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in dc.contamination(docs, items).collect()} == want
    assert [r["doc_id"] for r in dc.without_contaminated(docs, items).collect()] == [len(rows)]


def test_decontamination_of_awkward_rows(spark, monkeypatch):
    docs = awkward(spark)
    items = spark.createDataFrame(
        [(1, "the quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "one two"), (4, "w976x30 end"),
         (5, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    got = Counter((r["doc_id"], r["item_id"]) for r in dc.contamination(docs, items).collect())
    assert got == Counter({(1, 1): 1, (2, 1): 2, (1, 5): 1, (2, 5): 2})
    assert dc.without_contaminated(docs, items).count() == len(ROWS) - 3
    assert dc.contamination(docs, items.where("false")).count() == 0
    assert dc.contamination(nothing(spark), items).count() == 0
    monkeypatch.setattr(dc, "INDEX_BYTES", 10)      # several indexes find the same
    assert Counter((r["doc_id"], r["item_id"]) for r in dc.contamination(docs, items).collect()) == got
