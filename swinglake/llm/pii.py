"""Information-theoretic sanitisation of personal data, in DataFrame operations only.

Protected entities are the addresses, cards and phone numbers that patterns find.  A
term of the texts that hold an entity gives it away by ``PMI(term; entity)`` bits, of the
``IC(entity)`` bits there are; both are estimated from the whole corpus.
A term that gives away too large a share is generalised in the texts with that entity,
one that gives away nearly all is removed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import staged

SUPPORT = 3            # distinct texts of an entity a term must be in; all of them, if they are fewer
GENERALISE, REMOVE = 0.8, 0.95      # shares of an entity's information
SPAN = "array<struct<start: int, end: int>>"


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds candidates, ``valid`` (SQL over ``x.m``) keeps some; ``needs`` is quick to test and must hold."""

    name: str
    pattern: str
    valid: str
    needs: str


_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
# sum of the digits from the right, every second one doubled and its digits added
_LUHN = f"""aggregate(split(reverse({_DIGITS}), ''), named_struct('sum', 0, 'odd', true),
    (a, d) -> named_struct('sum', a.sum + CASE WHEN d = '' THEN 0 WHEN a.odd THEN int(d)
        ELSE int(d) * 2 - CASE WHEN int(d) > 4 THEN 9 ELSE 0 END END, 'odd', CASE WHEN d = '' THEN a.odd ELSE NOT a.odd END),
    a -> a.sum % 10 = 0)"""

# Repetitions are possessive where nothing after them could take a character back, and runs
# are entered at their start only (or where the last match ended): same matches, linear time.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "true", "instr(_text, '@') > 0"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"forall(split(x.m, '[.]'), p -> p rlike '^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$')", "instr(_text, '.') > 0"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}", "_text rlike '[0-9]'"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15", "instr(_text, '+') > 0"),
)
HOLDS = " OR ".join(f"size(_{k.name}) > 0" for k in KINDS)
WORD = r"\p{L}{3,}+"


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_of(text: str, kind: Kind) -> Column:
    """Spans of the kind's matches in column ``text`` that are valid, in code points.

    Pieces between matches and the matches themselves take turns, so their lengths add
    up to positions; both are made once, outside the lambda.
    """
    pattern = _literal(kind.pattern)
    found = F.expr(f"""aggregate(
        transform(arrays_zip(split({text}, {pattern}, -1), regexp_extract_all({text}, {pattern}, 0)),
                  z -> named_struct('p', z.`0`, 'm', z.`1`)),
        named_struct('at', 0, 'out', cast(array() AS {SPAN})),
        (a, x) -> named_struct(
            'at', a.at + length(x.p) + coalesce(length(x.m), 0),
            'out', CASE WHEN x.m IS NOT NULL AND ({kind.valid})
                THEN concat(a.out, array(named_struct('start', a.at + length(x.p), 'end', a.at + length(x.p) + length(x.m))))
                ELSE a.out END),
        a -> a.out)""")
    return F.when(F.expr(kind.needs), found).otherwise(F.expr(f"cast(array() AS {SPAN})"))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_text`` (null: empty), ``_text_key`` (its MD5) and ``_<kind>``, spans of each kind."""
    out = docs.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn("_text_key", F.md5("_text"))
    return out.withColumns({f"_{k.name}": spans_of("_text", k) for k in KINDS})


def _entities() -> Column:
    """Distinct ``kind:value`` of the base spans; values in lower case, numbers by their digits."""
    values = []
    for k in KINDS:
        plain = "lower(v)" if k.name == "email" else "regexp_replace(v, '[^0-9.]', '')" if k.name == "ip" \
            else "regexp_replace(v, '[^0-9]', '')"
        value = "substring(_text, s.start + 1, s.end - s.start)"
        values.append(f"transform(_{k.name}, s -> concat('{k.name}:', {plain.replace('(v', '(' + value)}))")
    return F.expr(f"array_distinct(concat({', '.join(values)}))")


def _words(text: str) -> Column:
    """Distinct words outside of addresses; other entities have no letters."""
    email = KINDS[0]
    text = f"CASE WHEN {email.needs} THEN regexp_replace({text}, {_literal(email.pattern)}, ' ') ELSE {text} END"
    return F.expr(f"array_distinct(transform(regexp_extract_all({text}, {_literal(WORD)}, 0), w -> lower(w)))")


def revealing_terms(based: DataFrame) -> DataFrame:
    """``_text_key, term, remove``: terms that give away an entity of the text, over the thresholds.

    ``based`` is ``with_base_spans`` of the corpus.  Shares are of all rows.  Every entity is
    assessed; one seen in a single text is given away by that text's rare words.
    Entities of the same texts have the same figures and are assessed as one, so a text
    meets each of its words once, however many entities only it holds.  Only texts that
    hold an entity are shuffled.
    """
    total = float(max(based.count(), 1))
    rows = staged(based.where(HOLDS).groupBy("_text_key").agg(F.count("*").alias("rows"), F.first("_text").alias("_text"),
                  *(F.first(f"_{k.name}").alias(f"_{k.name}") for k in KINDS)), "entity-texts")
    held = rows.select("_text_key", "rows", F.explode(_entities()).alias("entity"))
    same = [F.hex(F.bit_xor(F.xxhash64("_text_key", F.lit(seed)))) for seed in (0, 1)]
    known = held.groupBy("entity").agg(F.count("*").alias("in_texts"), F.sum("rows").alias("n_entity"),
                                       F.concat_ws(":", F.count("*"), *same).alias("unit"))
    held = staged(held.join(known, "entity").select(
        "_text_key", "rows", F.col("unit").alias("entity"), "in_texts", "n_entity").distinct(), "entities")
    listed = staged(rows.select("_text_key", F.explode(_words("_text")).alias("term")), "words")
    pairs = (listed.join(held, "_text_key").groupBy("entity", "term")
             .agg(F.count("*").alias("texts"), F.sum("rows").alias("n_both"), F.first("n_entity").alias("n_entity"),
                  F.first("in_texts").alias("in_texts"))
             .where(F.col("texts") >= F.least(F.lit(SUPPORT), F.col("in_texts"))))
    pairs = staged(pairs, "pairs")
    # every word of the corpus is counted before it meets the terms asked for
    seen = (based.select(F.explode(_words("_text")).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
            .join(pairs.select("term").distinct(), "term"))
    information = F.log2(F.lit(total) / F.col("n_entity"))
    mutual = F.log2(F.col("n_both") * F.lit(total) / (F.col("n_term") * F.col("n_entity")))
    share = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    over = (pairs.join(seen, "term").withColumn("share", share).where(F.col("share") >= GENERALISE)
            .select("entity", "term", (F.col("share") >= REMOVE).alias("remove")))
    over = staged(over, "disclosing")
    return (listed.join(held.select("_text_key", "entity"), "_text_key").join(over, ["entity", "term"])
            .groupBy("_text_key", "term").agg(F.max("remove").alias("remove")))


def sanitize(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii_spans`` and ``sanitized``.

    ``pii_spans``: array of ``kind, start, end``, kinds as in ``KINDS`` and then ``term``, each by
    start.  In ``sanitized`` an entity is replaced by ``[KIND]``, a generalised term by ``[TERM]``,
    a removed one by nothing; where spans overlap the first one stands for all.  A null text
    is empty; repeated rows are alike; columns of these names give way.
    """
    own = [c for c in docs.columns if c not in ("pii_spans", "sanitized")]
    based = with_base_spans(docs.select(*own))
    found = revealing_terms(with_base_spans(docs.select("text")))
    by_text = staged(found.groupBy("_text_key").agg(
        F.collect_set("term").alias("_terms"), F.collect_set(F.when(F.col("remove"), F.col("term"))).alias("_removed")),
        "text-terms")
    inside = " OR ".join(f"""exists(_{k.name}, s -> s.start < a.at + length(x.p) + length(x.m)
        AND s.end > a.at + length(x.p))""" for k in KINDS)
    word = Kind("term", WORD, f"array_contains(_terms, lower(x.m)) AND NOT ({inside})", "_terms IS NOT NULL")
    # a text without entities has no terms to look for and stays where it is
    joined = (based.where(HOLDS).join(by_text, "_text_key", "left").withColumn("_term", spans_of("_text", word))
              .unionByName(based.where(f"NOT ({HOLDS})").withColumns({
                  "_terms": F.expr("cast(NULL AS array<string>)"), "_removed": F.expr("cast(NULL AS array<string>)"),
                  "_term": F.expr(f"cast(array() AS {SPAN})")})))
    every = ", ".join(f"transform(_{k}, s -> named_struct('kind', '{k}', 'start', s.start, 'end', s.end))"
                      for k in [*(k.name for k in KINDS), "term"])
    spanned = joined.withColumn("pii_spans", F.expr(f"concat({every})"))
    label = """CASE WHEN s.kind <> 'term' THEN concat('[', upper(s.kind), ']')
        WHEN array_contains(_removed, lower(substring(_text, s.start + 1, s.end - s.start))) THEN '' ELSE '[TERM]' END"""
    clean = F.expr(f"""aggregate(
        array_sort(transform(pii_spans, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind))),
        named_struct('at', 0, 'out', ''),
        (a, s) -> named_struct('at', greatest(a.at, s.end), 'out', CASE WHEN s.start >= a.at
            THEN concat(a.out, substring(_text, a.at + 1, s.start - a.at), {label}) ELSE a.out END),
        a -> concat(a.out, substring(_text, a.at + 1)))""")
    return spanned.withColumn("sanitized", F.when(F.size("pii_spans") == 0, F.col("_text")).otherwise(clean)).select(
        *own, "pii_spans", "sanitized")
