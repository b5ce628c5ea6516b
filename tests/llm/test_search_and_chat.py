"""Nearest neighbours, personal data and conversations."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from swinglake.llm import ann, chat, pii
from tests.llm.corpus import ROWS, awkward, nothing

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def _nearest(rows, query_id, k):
    q = dict(rows)[query_id]
    scored = sorted((-float((np.array(v) * np.array(q)).sum()), i) for i, v in rows if i != query_id)
    return [i for _, i in scored[:k]]


def test_recall_of_the_index(spark):
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(2000, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit("mine"))
    exact = [(r["vec_id"], [float(a) for a in r["embedding"]]) for r in df.collect()]
    queries = df.where("vec_id % 40 = 0")
    got = ann.search(df, queries).collect()
    found = {(r["query_id"], r["vec_id"]) for r in got}
    want = {(q, i) for q in range(0, 2000, 40) for i in _nearest(exact, q, 20)}
    assert len(found & want) / len(want) >= 0.9
    whole = ann.search(df, queries, share=1.0).orderBy("query_id", "rank").collect()
    for q in (0, 400, 1960):
        assert [r["vec_id"] for r in whole if r["query_id"] == q] == _nearest(exact, q, 20)


def test_ties_copies_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 16)      # the large cell is cut
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100)] + [(i, [float(i), 1.0, 0.0, -1.0]) for i in range(100, 130)]
    rows += [(200, None), (201, [0.0] * 4), (202, [1.0, None, 1.0, 1.0]), (203, [1.0, float("nan"), 0.0, 0.0]),
             (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, df.where("vec_id % 20 = 0"), share=1.0).orderBy("query_id", "rank").collect()
    usable = [(i, v) for i, v in rows[:130]]
    for q in range(0, 130, 20):
        mine = [r for r in got if r["query_id"] == q]
        assert [r["vec_id"] for r in mine] == _nearest(usable, q, 20) and [r["rank"] for r in mine] == list(range(1, 21))
    assert {r["query_id"] for r in got} == set(range(0, 130, 20))
    assert ann.search(df.where("vec_id >= 200"), df).count() == 0
    few = df.where("vec_id IN (0, 100, 101)")
    assert ann.search(few, few.where("vec_id = 0")).count() == 2


def test_no_query_has_fewer_neighbours_than_there_are(spark):
    """With the default share, of 5, 10, 21 and 30 vectors."""
    rnd = np.random.default_rng(2)
    for n in (5, 10, 21, 30):
        rows = [(i, [float(a) for a in v]) for i, v in enumerate(rnd.normal(size=(n, 8)))]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        found = ann.search(df, df.where("vec_id % 4 = 0")).groupBy("query_id").count().collect()
        assert {r["count"] for r in found} == {min(n - 1, 20)} and len(found) == -(-n // 4)


def _luhn(digits: str) -> bool:
    twice = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(t - 9 if t > 9 else t for t in twice) % 10 == 0


def _base(text: str) -> list[tuple[str, int, int]]:
    def valid(kind, match):
        digits = re.sub("[^0-9]", "", match)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in match.split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and _luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()
    return [(k, m.start(), m.end()) for k, p in PATTERNS for m in re.finditer(p, text) if valid(k, m.group())]


def test_base_spans_are_those_of_the_patterns(spark):
    texts = [t or "" for _, t, _, _ in ROWS] + [
        "a@b.c_x@y.z a@b.c.@d.e x@y@z.com 😀 q@w.e.", "a" * 30_000 + " " + "7" * 30_000 + "12 " * 2000,
        "1.2.3.4.5.6.7.8 256.1.1.1 0000001.2.3.4 300.1.2.3.4", "+1 (386) 555-3733 +12 +1234567890123456 ++49 30 123456",
        "4111 1111 1111 1111-2 4111-1111-1111-1111 4111  1111", "@ . + 1"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.sanitize(df).collect():
        assert [tuple(s) for s in r["pii_spans"] if s["kind"] != "term"] == _base(r["text"])


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, f"Patient Zanzibar wrote from ann.lee@mail.example number {'abcdefgh'[i]}{'x' * i}") for i in range(6)]
    rows += [(10 + i, f"Sometimes quarrel {'uvw'[i % 3]} for ann.lee@mail.example") for i in range(4)]
    rows += [(30 + i, f"a quarrel number patient {i}") for i in range(2)] + [(50 + i, f"nothing of note patient wrote from for number {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pii_spans", F.lit("mine"))
    got = {r["doc_id"]: r for r in pii.sanitize(docs).collect()}
    assert len(got) == len(rows)
    # zanzibar is only seen with the entity: removed; quarrel mostly: generalised; the rest stays
    assert got[0]["sanitized"] == "Patient  wrote from [EMAIL] number a"
    assert got[10]["sanitized"] == " [TERM] u for [EMAIL]"
    assert [s["kind"] for s in got[0]["pii_spans"]] == ["email", "term"]
    assert got[30]["sanitized"] == "a quarrel number patient 0"


def test_entities_of_one_text_are_assessed(spark):
    rows = [(1, "Patient Zanzibar wrote quarrel from ann.lee@mail.example for +1 (017) 555-7713")]
    rows += [(2 + i, f"Mister Quux wrote from bob@mail.example number {'abcdefgh'[i] * 3}") for i in range(2)]
    rows += [(10 + i, f"a quarrel number {i}") for i in range(3)] + [(50 + i, f"Patient wrote from for number {i}") for i in range(2000)]
    rows += [(5000 + i, "Mister number") for i in range(500)]
    got = {r["doc_id"]: r for r in pii.sanitize(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # zanzibar is only in this text: removed; quarrel is rare elsewhere: generalised
    assert got[1]["sanitized"] == "Patient  wrote [TERM] from [EMAIL] for [PHONE]"
    # quux is in both texts of its entity; aaa only in one of them
    assert got[2]["sanitized"] == "Mister  wrote from [EMAIL] number aaa"


def test_sanitising_awkward_rows(spark):
    got = pii.sanitize(awkward(spark))
    assert got.count() == len(ROWS) and got.where("sanitized <> coalesce(text, '')").count() == 0
    assert pii.sanitize(nothing(spark)).count() == 0


MESSAGES = [
    (1, 0, "user", "Hello there my friends.\nHow are   you all today?\nline three is here"),
    (1, 1, "a", "I am fine, thanks a lot."),
    (1, 2, "user", "On Monday, Bob wrote:\n> hello there my friends.\n> How are you all today?\nReply to both lines."),
    (1, 3, "a", ">> How are you\n>> all today?\n> Reply to both lines.\nok then"),
    (1, 4, "b", "> unknown text here\nlast words"),
    (1, 5, "b", "> I am fine, thanks a lot.\nfive"),
    (1, 5, "b", "> I am fine, thanks a lot.\nfive"),
    (1, 6, "c", "> ok then\nsix"),
    (2, 0, "u", None), (2, 1, "u", ""), (None, 1, "u", "x"), (3, None, "u", "> q\ny"),
]


def test_conversations_in_reply_order(spark):
    df = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string").withColumn("branch", F.lit("mine"))
    got = [tuple(r) for r in chat.conversations(df).orderBy(F.col("conv_id").asc_nulls_last(), "position").collect()]
    # conversation, position, turn, role, reply to, depth, branch, quotes, linked, text
    assert got == [
        (1, 1, 0, "user", None, 0, 0, 0, 0, "Hello there my friends.\nHow are   you all today?\nline three is here"),
        (1, 2, 1, "a", 0, 1, 1, 0, 0, "I am fine, thanks a lot."),
        (1, 3, 5, "b", 1, 2, 1, 1, 1, "five"),
        (1, 4, 5, "b", 1, 2, 1, 1, 1, "five"),
        (1, 5, 2, "user", 0, 1, 2, 1, 2, "Reply to both lines."),
        (1, 6, 3, "a", 2, 2, 2, 2, 2, "ok then"),
        (1, 7, 6, "c", 3, 3, 2, 1, 1, "six"),
        (1, 8, 4, "b", 0, 1, 4, 1, 0, "last words"),
        (2, 1, 0, "u", None, 0, 0, 0, 0, ""),
        (2, 2, 1, "u", 0, 1, 1, 0, 0, ""),
        (3, 1, None, "u", None, 0, None, 1, 0, "y"),
        (None, 1, 1, "u", None, 0, 1, 0, 0, "x"),
    ]
    assert chat.conversations(df.where("false")).count() == 0


def test_a_long_chain_of_replies(spark):
    rows = [(7, 0, "u", "word zero of all")]
    rows += [(7, i, "u", f"> word {i - 1} of all\nword {i} of all" if i > 1 else "> word zero of all\nword 1 of all") for i in range(1, 70)]
    got = chat.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert [(r["turn"], r["depth"], r["position"]) for r in got.orderBy("position").collect()] == [(i, i, i + 1) for i in range(70)]
    assert {r["branch"] for r in got.where("turn > 0").collect()} == {1}
