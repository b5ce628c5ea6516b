"""The pipeline's stages, each against what it must leave."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer

from swinglake.llm import decontamination as dc
from swinglake.llm import mixing, toxicity
from swinglake.llm.common import staged, table
from tests.llm.corpus import awkward
from tests.llm.test_jaccard import _brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "decontamination", "mixing", "token_ids"]
    docs = table(spark, SF_DIR, "documents")
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        out = staged(stage(spark, docs, SF_DIR), name)
        if name != "token_ids":
            assert out.columns == list(corpus_pipeline.COLUMNS)
        outputs.append([docs.collect(), out.collect()])
        docs = out

    (before, after), chain = outputs[0], toxicity.fit_chain(
        table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"), toxicity.label_categories())
    assert Counter(r["doc_id"] for r in after) == Counter(
        r["doc_id"] for r in before if chain.probabilities(r["text"])[1] < toxicity.THRESHOLD)

    before, after = outputs[1]
    assert {r["doc_id"] for r in after} == {c for *_, c in _brute([(r["doc_id"], r["text"]) for r in before])}
    assert len(after) == len({r["doc_id"] for r in after})

    before, after = outputs[2]
    items = [" " + " ".join(dc._words(r["text"].lower())) + " " for r in table(spark, SF_DIR, "benchmark").collect()]
    held = {r["doc_id"] for r in before if any(i in " " + " ".join(dc._words(r["text"].lower())) + " " for i in items)}
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - held

    before, after = outputs[3]
    source = spark.createDataFrame(before, table(spark, SF_DIR, "documents").schema)
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in mixing.mix(source).collect())

    before, after = outputs[4]
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert Counter((r["doc_id"], r["n_tokens"]) for r in after) == Counter(
        (r["doc_id"], len(plain.encode(r["text"], add_special_tokens=False).ids) + 1) for r in before)


def test_stages_bear_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), name)
        assert docs.count() > 0
    empty = awkward(spark).where("false")
    for name, stage in corpus_pipeline.STAGES:
        empty = staged(stage(spark, empty, SF_DIR), name)
        assert empty.count() == 0
