"""Sharding, mixing and token files."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from swinglake.llm import mixing, sharding, token_orc
from tests.llm.corpus import ROWS, awkward, nothing

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_shards_are_near_equal_and_gapless(spark, tmp_path):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("ab "), F.pmod(F.xxhash64("id"), F.lit(90)).cast("int")).alias("text"))
    slotted = sharding.with_slots(docs, slots=512)
    weights, rows = sharding.slot_weights(slotted, 512)
    first = sharding.SlotMap.even(24, 512)
    first.save(spark, str(tmp_path))
    second = first.rebalanced(weights)
    second.save(spark, str(tmp_path))
    loaded = sharding.SlotMap.load(spark, str(tmp_path), 2)
    assert loaded.shards == 24 and (loaded.shard_of == second.shard_of).all()
    got = sharding.place(slotted, loaded, rows).collect()
    held, places = Counter(), defaultdict(list)
    for r in got:
        held[r["shard"]] += r["size"]
        places[r["shard"]].append(r["slot"])
        assert r["size"] == len(r["text"].encode()) + 8 and r["text_crc32"] == zlib.crc32(r["text"].encode())
    assert len(got) == 3000 and sorted(held) == list(range(24))
    assert max(held.values()) - min(held.values()) < 0.01 * sum(held.values()) / 24
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    # a map edited for one more shard gives it a share and moves little else
    third = second.rebalanced(weights, 25)
    load = np.bincount(third.shard_of, weights=weights, minlength=25)
    assert load.max() - load.min() < 0.02 * load.mean()
    moved = weights[third.shard_of != second.shard_of].sum()
    assert moved < 0.15 * weights.sum()


def test_sharding_of_awkward_rows(spark):
    slotted = sharding.with_slots(awkward(spark))
    weights, rows = sharding.slot_weights(slotted)
    got = sharding.place(slotted, sharding.SlotMap.even(3).rebalanced(weights), rows).collect()
    assert len(got) == len(ROWS)
    assert sorted(r["size"] for r in got) == sorted(len((t or "").encode()) + 8 for _, t, _, _ in ROWS)
    empty = sharding.with_slots(nothing(spark))
    weights, rows = sharding.slot_weights(empty)
    assert sharding.place(empty, sharding.SlotMap.even(3).rebalanced(weights), rows).count() == 0


def _copies(rate: float, u: float) -> int:
    p = c = math.exp(-rate)
    k = 0
    while c <= u:
        k += 1
        p *= rate / k
        c += p
    return k


def test_copies_follow_the_inverted_poisson_distribution(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("ten bytes.").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "warm").alias("source"))
    weights = spark.createDataFrame([("hot", 1), ("warm", 4), (None, 1)], "mix_source string, mix_weight long")
    got = mixing.mix(docs, weights, epochs=2.0).collect()
    n = Counter(r["source"] for r in docs.collect())
    share = {"hot": 1 / 6, "warm": 4 / 6, None: 1 / 6}
    want = Counter()
    for r in docs.collect():
        u = int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2 ** 52
        want[r["doc_id"]] = _copies(share[r["source"]] * 2 * 4000 / n[r["source"]], u)
    assert Counter(r["doc_id"] for r in got) == +want
    made = Counter(r["source"] for r in got)
    assert all(abs(made[s] / sum(made.values()) - share[s]) < 0.03 for s in share)
    assert all(sorted(x for x in range(1, r["copies"] + 1)) and 1 <= r["copy"] <= r["copies"] for r in got)
    ids = [r["doc_id"] for r in got]
    assert np.corrcoef(ids, range(len(ids)))[0, 1] < 0.05      # shuffled


def test_a_tiny_source_of_a_large_table(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 700)
    big = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.lit(1000)).alias("text"), F.lit("big").alias("source"))
    tiny = spark.createDataFrame([(9999, "y", None)], "doc_id long, text string, source string")
    got = mixing.mix(big.unionByName(tiny)).where("source IS NULL").collect()
    rate = 5_000_001 / (2236 + 1)
    assert rate > mixing.MAX_RATE and len(got) == got[0]["copies"] and abs(len(got) - rate) < 6 * rate ** .5
    assert sorted(r["copy"] for r in got) == list(range(1, len(got) + 1)) and abs(got[0]["rate"] - rate) < 1e-6

    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("z").alias("text"), F.lit("s").alias("source"))
    weights = spark.createDataFrame([("s", 1)], "mix_source string, mix_weight long")
    drawn = {r["doc_id"]: r["copies"] for r in mixing.mix(docs, weights, epochs=1500.0).where("copy = 1").collect()}
    for i, n in drawn.items():
        us = [int(hashlib.md5(f"mix:{i}:draw:{k}".encode()).hexdigest()[:13], 16) / 2 ** 52 for k in range(1, 16)]
        assert n == sum(_copies(100.0, u) for u in us)
    counts = np.array(list(drawn.values()))
    assert len(counts) == 300 and abs(counts.mean() - 1500) < 5 * (1500 / 300) ** .5 and 0.6 < counts.var() / 1500 < 1.5


def test_mixing_of_awkward_rows(spark):
    got = mixing.mix(awkward(spark)).collect()
    assert {(r["doc_id"], r["text"]) for r in got} <= {(i, t) for i, t, _, _ in ROWS}
    assert "mine" not in {r["rate"] for r in got}
    assert mixing.mix(nothing(spark)).count() == 0


def test_token_files_hold_what_the_tokenizer_says(spark, tmp_path):
    at = f"{tmp_path}/tokens"
    token_orc.write_tokens(awkward(spark), at, TOKENIZER)
    got = token_orc.digests(token_orc.read_tokens(spark, at)).orderBy("start").collect()
    plain = Tokenizer.from_file(TOKENIZER)
    ids = [(i, np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4")) for i, t, _, _ in ROWS]
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
        (i, len(x), zlib.crc32(x.tobytes())) for i, x in ids)
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    some = token_orc.read_tokens(spark, at, [6, 8])
    assert "PushedFilters: [In(doc_id" in some._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["doc_id"] for r in some.collect()) == [6, 8]
    token_orc.write_tokens(nothing(spark), f"{tmp_path}/none", TOKENIZER)
    assert token_orc.digests(token_orc.read_tokens(spark, f"{tmp_path}/none")).count() == 0


def test_words_are_encoded_as_in_their_text():
    encoder = token_orc.WordEncoder(TOKENIZER)
    texts = ["don't I'll 'tis STRASSE Straße. ΑΣ Σ. Å ª º x² ½ ǅ ﬁ é É! é.", "a\x1cb \x85z\xa0q 4.5,6 ... !!! x!?",
             "日本語。テスト, a-b_c 12a", "", "  \n\t "]
    for text in texts:
        plain = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<i4").tolist() == plain


def test_words_are_cached_once_and_in_bounds(monkeypatch):
    """A word that is its own part takes one place; two generations bound the cache, and ids do not depend on it."""
    encoder = token_orc.WordEncoder(TOKENIZER)
    encoder.encode("alpha Alpha alpha, ALPHA!")
    assert set(encoder) == {"alpha", "Alpha", "alpha,", ",", "ALPHA!", "!"} and not hasattr(encoder, "pieces")
    monkeypatch.setattr(token_orc, "_CACHE", 5)
    small, whole = token_orc.WordEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text in ("a b c d e f g h a b c d e f g h", "Äbc, äbc! ÄBC?! naïve; x² ªº -- ... ,", "one, Two one two. ONE! three"):
        ids = np.frombuffer(small.encode(text), "<i4").tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids
        assert len(small) <= 5 and len(small.older) <= 5


def test_texts_encoded_together_are_as_the_tokenizer_says():
    """Special tokens are found as they are written, words followed by any marks are cut there, and no white space counts."""
    encoder, whole, end = token_orc.WordEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER), b"\1\0\0\0"
    texts = ["don't I'll 'tis dogs' STRASSE Straße. ΑΣ Σ. Å ª º x² µ ½ ǅ ﬁ é É! é. [a] b) \"c\" d,%%% e.*** f's. g'", "", None,
             "a\x1cb c\x1dd", "\x1e", "a<|endoftext|>b, <|ENDOFTEXT|>x <|endoftext|>. <|endoftext| > x<|startoftext|>'s",
             "日本語。テスト, a-b_c 12a 4.5,6 3% ... !!! x!?", "  \n\t ", "one One ONE, one. \x85 one\xa0two three　", "x\x1f"]
    texts += ["".join(f"a{chr(c)}b" for c in range(a, a + 256)) for a in range(0, 0x3100, 256)]
    for some in (pa.array(texts), pa.array(["x", *texts, "y"]).slice(1, len(texts)), pa.array(texts, pa.large_string())):
        ids, ends = encoder.encode_all(some, end)
        got = np.split(np.frombuffer(ids, "<i4")[:ends[-1]], ends[:-1])
        for text, found in zip(texts, got, strict=True):
            assert found.tolist() == [*whole.encode(text or "", add_special_tokens=False).ids, 1], text
    for text in texts:
        assert np.frombuffer(encoder.encode(text or ""), "<i4").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_a_word_is_looked_up_once_for_many_texts():
    """However often a word occurs, in whatever case and before whatever marks, its letters are looked up once."""
    encoder, asked = token_orc.WordEncoder(TOKENIZER), Counter()
    look = encoder.__class__.__missing__

    class Counting(token_orc.WordEncoder):
        def __missing__(self, word):
            asked[word] += 1
            return look(self, word)

    _, ends = Counting(TOKENIZER).encode_all(pa.array(["Alpha alpha, ALPHA.%%% 'alpha 7"] * 1000), b"\1\0\0\0")
    assert len(ends) == 1000 and asked["alpha"] == 1 and set(asked) == {"alpha", "", ",", ".%%%", "'alpha", "7"}


def test_ranges_of_rows_are_of_like_size():
    ends = np.cumsum([3, 3, 3, 50, 0, 0, 2, 2])
    for most in (1, 6, 10, 100):
        ranges = list(token_orc._cuts(ends, most))
        assert [i for a, b in ranges for i in range(a, b)] == list(range(8))
        assert all(b - a == 1 or ends[b - 1] - (ends[a - 1] if a else 0) <= most for a, b in ranges)
    assert list(token_orc._cuts(ends, 100)) == [(0, 8)] and list(token_orc._cuts(ends[:0], 9)) == []
