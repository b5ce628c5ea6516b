"""Line deduplication, divergence of sources and spelling variants, against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from swinglake.llm import divergence, line_dedup, spelling
from tests.llm.corpus import CLASHING, awkward, nothing

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TO_LOWER = str.maketrans(UPPER, UPPER.lower())


# --- lines -----------------------------------------------------------------

def _line_key(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(TO_LOWER)


def _deduplicated(rows, length=10, documents=2):
    """(id, text) -> (id, lines, dropped, kept text); rows of one id are one document."""
    holders = defaultdict(set)
    for i, text in rows:
        for key in {_line_key(x) for x in (text or "").split("\n")}:
            if len(key) >= length:
                holders[key].add(i)
    out = []
    for i, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            held = holders.get(_line_key(line), [])
            first = min((h for h in held if h is not None), default=None)
            if len(held) < documents or i == first:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def _line_rows():
    rnd = random.Random(5)
    pool = [f"line number {i:03d} of them" for i in range(40)] + ["short", "", "  ", "ÀÉ straße is long", "tenletters"]
    rows = []
    for i in range(300):
        lines = [rnd.choice(pool) for _ in range(rnd.randrange(6))] + [f"own line of document {i}"] * rnd.randrange(3)
        lines = [x.upper() if rnd.random() < .1 and "ß" not in x else f"\t{x} \r" if rnd.random() < .1 else x for x in lines]
        rnd.shuffle(lines)
        rows.append((i * 7 % 301, "\n".join(lines)))
    return rows + [(400, None), (401, ""), (402, "\n\n"), (403, "a license line\n" * 3000 + "tail")]


@pytest.mark.parametrize("documents", [2, 3])
def test_lines_against_plain_python(spark, documents, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", 20)      # some lines are met by broadcast, others by shuffle
    rows = _line_rows()
    got = line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"),
                                            least_documents=documents)
    assert sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect())) == sorted(
        _deduplicated(rows, documents=documents))


def test_lines_of_awkward_rows(spark):
    docs = awkward(spark).withColumns({c: F.lit("mine") for c in ("_id", "_LOST", "line", "kept_text", "n_lines")})
    got = line_dedup.without_repeated_lines(docs)
    assert got.columns == [c for c in docs.columns if c not in ("kept_text", "n_lines")] + ["n_lines", "n_dropped", "kept_text"]
    rows = got.collect()
    want = _deduplicated([(r["doc_id"], r["text"]) for r in docs.collect()])
    order = lambda x: (x[0] is None, x[0] or 0, x[3])
    assert sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in rows], key=order) == sorted(want, key=order)
    assert all(r[c] == "mine" for r in rows for c in (*CLASHING, "_id", "_LOST", "line"))
    assert line_dedup.without_repeated_lines(nothing(spark)).count() == 0


def test_lines_need_no_python(spark):
    plan = line_dedup.without_repeated_lines(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# --- divergence ------------------------------------------------------------

def _audited(rows, least=3, top=200):
    """(text, lang, source) -> rows of the audit."""
    rows = [(t or "", a or "", b or "") for t, a, b in rows]
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text.translate(TO_LOWER))
        counts[lang, source].update(terms)
        documents[lang].update(set(terms))
    out = []
    for lang in documents.keys() | {lang for lang, _ in counts}:
        kept = sorted(t for t, n in documents[lang].items() if n >= least)
        sources = sorted(b for a, b in counts if a == lang)
        whole = sum((counts[lang, b] for b in sources), Counter())

        def p(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // total for t in kept}
        shares, q = {b: p(counts[lang, b]) for b in sources}, p(whole)
        f = lambda x, y: (x - y) ** 2 // y
        for b in sources:
            pairs = [(-sum(f(shares[b][t], shares[o][t]) for t in kept), o.encode()) for o in sources if o != b]
            terms = [(-f(shares[b][t], q[t]), t.encode()) for t in kept if counts[lang, b][t] and shares[b][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, b, part, o.decode(), -v, k) for k, (v, o) in enumerate(found, 1)]
    return sorted(out)


def test_divergence_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TERMS", 10)
    monkeypatch.setattr(divergence, "GROUPS", 4)        # several blocks of groups in several tiles
    rnd = random.Random(3)
    rows = [(None, None, None), ("", "xx", "only"), ("a b c", "yy", "p"), ("d e", "yy", "q"), ("The END the", "en", None)]
    for _ in range(400):
        source = rnd.randrange(11)
        words = [f"{rnd.choice('abcdeÀÉß')}{rnd.choice('fghij😀')}{rnd.choice('KLMN')}{'x' * (source % 3)}" for _ in range(rnd.randrange(12))]
        rows.append((rnd.choice([" ", "1", "_-", "\n"]).join(words), rnd.choice(["en", "de"]), f"s{source}"))
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    assert sorted(map(tuple, divergence.audit(docs, top_terms=20).collect())) == _audited(rows, top=20)


def test_divergence_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("term", F.lit("mine"))
    got = sorted(map(tuple, divergence.audit(docs).collect()))
    assert got == _audited([(r["text"], r["lang"], r["source"]) for r in docs.collect()])
    assert divergence.audit(nothing(spark)).count() == 0


def test_shares_of_very_large_counts(spark):
    counts, total = np.array([0, 10 ** 12, 3 * 10 ** 14]), np.int64(4 * 10 ** 14)
    want = [1 + 10 ** 9 * (c + 1) // int(total) for c in counts.tolist()]
    assert divergence.shares(counts, total).tolist() == want
    rows = spark.createDataFrame([(c, int(total)) for c in counts.tolist()], "n long, t long")
    assert [r[0] for r in rows.select(divergence._share("n", "t")).collect()] == want


def test_quadrants_without_counts_are_not_entered():
    totals = np.array([10, 20])
    tree = divergence.QuadTree(np.array([0, 1]), np.array([7, 7]), np.array([3, 4]), totals, 3)
    assert [int(b.sum()) for b in tree.bits] == [1, 1, 2] and tree.shares.tolist() == [1 + 4 * 10 ** 8, 1 + 25 * 10 ** 7]
    empty = divergence.QuadTree(*[np.array([], np.int64)] * 3, totals, 3)
    ab, ba = divergence.pair_prices(empty, empty, 3, 8, totals, totals, True)
    p, q = 1 + 10 ** 8, 1 + 5 * 10 ** 7
    assert ab[0, 1] == 8 * ((p - q) ** 2 // q) and ba[0, 1] == 8 * ((p - q) ** 2 // p)


# --- spelling --------------------------------------------------------------

def _counted(rows, length=6, least=5):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= length and c >= least}


def _one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def _variants(rows):
    n, form, near = _counted(rows), {}, {}
    for w in n:
        near[w] = [x for x in n if _one_apart(w, x)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def _misspelt(count: int, alphabet: str, seed: int):
    """Texts of a few stems and of words some edits from them, and words whose forms make a chain."""
    rnd, rows = random.Random(seed), []
    stems = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(6, 12))) for _ in range(30)]
    for i in range(count):
        words = []
        for _ in range(60):
            word = list(rnd.choice(stems))
            while rnd.random() < .3:
                at = rnd.randrange(len(word))
                word[at:at + rnd.randrange(2)] = rnd.choice(["", rnd.choice(alphabet)])
            words.append("".join(word).upper() if rnd.random() < .1 and "ÿ" not in word else "".join(word))
        rows.append((i, rnd.choice([" ", ", ", "1", "日"]).join(words)))
    chain = "chainwo " * 6 + "chainwor " * 40 + "chainword " * 300
    return rows + [(None, "without an id"), (None, None), (900, ""), (901, None), (902, chain)]


@pytest.mark.parametrize("block, alphabet", [(4000, "abcdéÿ"), (8, "ab")])
def test_variants_against_plain_python(spark, block, alphabet):
    """The second case cuts every bucket down to single letters."""
    rows = _misspelt(400, alphabet, block)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, spelling.variants(docs, block=block).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()), key=lambda r: r[0])
    want = _variants(rows)
    assert got == want
    assert any(r[1] not in (None, r[2]) for r in want), "no chain of forms"


def test_spelling_of_awkward_rows(spark):
    docs = awkward(spark).withColumns({c: F.lit("mine") for c in ("word", "form", "length", "key")})
    got = sorted(map(tuple, spelling.variants(docs).collect()))
    assert got == _variants([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert spelling.variants(nothing(spark)).count() == 0


def test_index_finds_all_near_words():
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randrange(5, 9))) for _ in range(200)})
    index = spelling.PositionIndex(words)
    for length in range(4, 10):
        found = {(words[i], words[j]) for rows in index.near(length, 7) for i, j in zip(*rows)}
        assert found == {(a, b) for a in words for b in words
                         if len(a) == length and len(b) >= length and _one_apart(a, b)}


def test_registered_queries_have_the_columns_of_their_contract(spark):
    from swinglake.llm.catalog import ENTRIES
    sf = "/root/testdata/sf0.001"
    assert ENTRIES["op12_line_dedup"].query(spark, sf).dtypes == [
        ("doc_id", "bigint"), ("n_lines", "bigint"), ("n_dropped", "bigint"), ("kept_sha256", "string")]
    assert ENTRIES["op11_quadtree_divergence"].query(spark, sf).dtypes == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert ENTRIES["op13_bit_sliced_spelling"].query(spark, sf).dtypes == [
        ("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    first = ENTRIES["op12_line_dedup"].query(spark, sf).where("n_dropped = 0").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("doc_id") == first["doc_id"]).first()["text"]
    assert first["kept_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
