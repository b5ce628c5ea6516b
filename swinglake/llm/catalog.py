"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from swinglake.catalog.registry import Entry, Query
from swinglake.llm import (
    ann, chat, decontamination, divergence, jaccard, line_dedup, lm, mixing, pii, sharding, spelling, token_orc, toxicity,
)
from swinglake.llm.common import staged, table
from swinglake.session import scratch_dir

ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        ENTRIES[name] = Entry(fn, sql)
        return fn
    return register


@query("op1_virtual_slots")
def virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on 24 shards of nearly equal bytes: an even map, rebalanced once."""
    docs = table(spark, sf_dir, "documents")
    slotted = staged(sharding.with_slots(docs).select("doc_id", "virtual_slot", "size", "text_crc32"), "slots")
    weights, rows = sharding.slot_weights(slotted)
    maps = scratch_dir(spark, "slot-map")
    first = sharding.SlotMap.even(24)
    first.save(spark, maps)
    edited = first.rebalanced(weights)
    edited.save(spark, maps)
    placed = sharding.place(slotted, sharding.SlotMap.load(spark, maps, edited.version), rows)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@query("op2_toxicity_chain")
def toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of every document, and whether the toxicity stage rejects it."""
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.fit_chain(docs, table(spark, sf_dir, "labels"), toxicity.label_categories())
    return toxicity.scores(docs, chain).withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


@query("op3_multi_index")
def multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.where(F.col("vec_id") % 20 == 0))


@query("op4_backoff_automaton")
def backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents under a model of those not held out."""
    return lm.scores(table(spark, sf_dir, "documents"))


@query("op5_benchmark_wand")
def benchmark_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a test item, with the item and what overlaps."""
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


JACCARD_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT u, v FROM common JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reached AS (SELECT doc_id, doc_id AS other FROM words UNION
  SELECT reached.doc_id, links.v FROM reached JOIN links ON links.u = reached.other)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM words
LEFT JOIN sizes ON sizes.doc_id = words.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) r ON r.doc_id = words.doc_id"""


@query("op6_signature_trees", JACCARD_SQL)
def signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_information_sanitisation")
def information_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents, and the terms that give it away."""
    cleaned = pii.sanitize(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.expr(f"cast(size(filter(pii_spans, s -> s.kind = '{kind}')) AS bigint)")
    spelt = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return cleaned.select(
        "doc_id", *(of(k.name).alias(f"n_{k.name}") for k in pii.KINDS),
        F.sha2(F.expr(spelt.format("filter(pii_spans, s -> s.kind <> 'term')")), 256).alias("base_sha256"),
        F.expr(spelt.format("pii_spans")).alias("spans"), of("term").alias("n_term"),
        F.crc32(F.col("sanitized").cast("binary")).alias("sanitized_crc32"))


MIX_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source AS s, CAST(sum(coalesce(strlen(text), 0)) AS BIGINT) AS b FROM {docs} GROUP BY source),
weights AS (SELECT s, b, CAST(floor(sqrt(b)) AS BIGINT) AS w FROM sizes),
rates AS (SELECT s, CASE WHEN b = 0 THEN 1.0::DOUBLE ELSE
    1.0::DOUBLE * w::DOUBLE * (SELECT sum(b) FROM weights)::DOUBLE
    / ((SELECT sum(w) FROM weights)::DOUBLE * b::DOUBLE) END AS rate FROM weights),
dist AS (SELECT s, rate, 0 AS i, exp(-rate) AS p, exp(-rate) AS c FROM rates
  UNION ALL SELECT s, rate, i + 1, p * rate / (i + 1), c + p * rate / (i + 1) FROM dist
  WHERE i + 1 <= ceil(rate + 12 * sqrt(rate) + 30)),
drawn AS (SELECT *, coalesce(CAST(doc_id AS VARCHAR), text, '') AS name FROM {docs}),
units AS (SELECT *, ('0x' || substr(md5('mix:' || name), 1, 13))::UBIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM drawn),
counted AS (SELECT units.*, rate, CAST((SELECT count(*) FROM dist
    WHERE dist.s IS NOT DISTINCT FROM units.source AND dist.c <= units.u) AS INTEGER) AS copies
  FROM units JOIN rates ON units.source IS NOT DISTINCT FROM rates.s),
copied AS (SELECT *, unnest(range(1, copies + 1)) AS k FROM counted)
SELECT {cols} FROM copied"""


@query("op8_poisson_mix", MIX_SQL.format(docs="documents", cols="""
  doc_id, text, lang, source, n_chars, rate, copies, CAST(k AS INTEGER) AS copy,
  md5('mix:' || name || ':' || k) AS shuffle_key"""))
def poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated so that each source has a share as the root of its bytes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op9_token_orc")
def token_orc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as ORC and read back."""
    return write_and_digest(table(spark, sf_dir, "documents"))


def write_and_digest(docs: DataFrame) -> DataFrame:
    path = scratch_dir(docs.sparkSession, "token-orc")
    token_orc.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_orc.digests(token_orc.read_tokens(docs.sparkSession, path))


@query("op10_quotation_linking")
def quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All messages in reply order, without quotes."""
    return chat.conversations(table(spark, sf_dir, "conversations"))


DIVERGENCE_SQL = r"""
WITH words AS (SELECT doc_id, row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
whole AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
sized AS (SELECT g.lang, g.source, coalesce(w.v, 0)::HUGEINT AS v, coalesce(w.total, 0)::HUGEINT AS lang_total,
    coalesce(sum(c.n), 0)::HUGEINT AS total
  FROM groups g LEFT JOIN whole w ON w.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
priced AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.total + s.v))::BIGINT AS p,
    (1 + (1000000000::HUGEINT * (k.n + 1)) // (s.lang_total + s.v))::BIGINT AS q
  FROM sized s JOIN kept k ON k.lang = s.lang
  LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every_pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source),
ranked AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (
    PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM every_pair
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q, row_number() OVER (
    PARTITION BY lang, source ORDER BY ((p - q) * (p - q)) // q DESC, encode(term))
  FROM priced WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200"""


@query("op11_quadtree_divergence", DIVERGENCE_SQL)
def quadtree_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are from each other, and the terms that set them apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


LINES_SQL = r"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.first AS dropped FROM keyed k LEFT JOIN repeated r ON r.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


@query("op12_line_dedup", LINES_SQL)
def line_dedup_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without the lines that earlier ones hold."""
    cleaned = line_dedup.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped",
                          F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query("op13_bit_sliced_spelling")
def bit_sliced_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents and the more frequent form that each is a misspelling of."""
    return spelling.variants(table(spark, sf_dir, "documents"))
