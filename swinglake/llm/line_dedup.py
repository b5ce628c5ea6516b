"""Lines that many documents share, dropped everywhere but in one; DataFrame operations only.

Lines are exploded with a hash of their normal form.  Distinct documents are counted per
hash, with partial counts before each shuffle; hashes over the threshold meet the lines again
and give each document the positions it loses, from which it is put together anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import free_names, lower_ascii, staged

LEAST_LENGTH = 10       # code points of a normalised line that counts
LEAST_DOCUMENTS = 2     # documents that make a line a repeated one
HOT = 4096              # a repeated line with more than this part of their rows is met by broadcast
BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def listed_lines(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``doc_id, content, at, line``: each long enough line, as the 16-byte MD5 of its normal form.

    ``content`` hashes the whole text, ``at`` counts its lines from 0.
    """
    lowered = F.posexplode(_lines(lower_ascii(F.col("text")))).alias("at", "raw")
    return (docs.select("doc_id", F.xxhash64("text").alias("content"), lowered)
            .withColumn("normal", F.btrim("raw", F.lit(BLANKS))).where(F.char_length("normal") >= least_length)
            .select("doc_id", "content", "at", F.unhex(F.md5("normal")).alias("line")))


def repeated_lines(listed: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``line, n_documents, n_lines, first``: lines that at least so many documents hold.

    ``first`` is the least doc_id that holds the line, null only if no other id holds it.
    """
    by_document = listed.groupBy("line", "doc_id").agg(F.count("*").alias("n_lines"))
    return (by_document.groupBy("line")
            .agg(F.count("*").alias("n_documents"), F.sum("n_lines").alias("n_lines"), F.min("doc_id").alias("first"))
            .where(F.col("n_documents") >= least_documents))


def _lost_positions(listed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``doc_id, content, lost``: positions of the lines that each text loses.

    The few lines that make up much of all repeated ones are met by a broadcast of at most
    ``HOT`` rows; no other is more than that part of what is shuffled.
    """
    total = repeated.agg(F.coalesce(F.sum("n_lines"), F.lit(0))).first()[0]
    heavy = F.col("n_lines") * F.lit(HOT) > F.lit(total)
    hot = repeated.where(heavy).select("line", F.col("first").alias("hot_first"), F.lit(True).alias("hot"))
    met = listed.join(F.broadcast(hot), "line", "left")
    elsewhere = ~F.col("doc_id").eqNullSafe(F.col("first"))
    place = ("doc_id", "content", "at")
    lost = (met.where("hot").withColumnRenamed("hot_first", "first").where(elsewhere).select(*place)
            .unionByName(met.where("hot IS NULL").join(repeated.where(~heavy).select("line", "first"), "line")
                         .where(elsewhere).select(*place)))
    return lost.groupBy("doc_id", "content").agg(F.collect_set("at").alias("lost"))


def without_repeated_lines(docs: DataFrame, least_length: int = LEAST_LENGTH,
                           least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    Lines end at ``\\n``; a null or empty text is one empty line.  Lines are alike when they are
    equal without blanks at both ends and with A-Z in lower case.  A line of at least
    ``least_length`` code points that is in at least ``least_documents`` documents stays, wherever
    it stands there, in the document with the least doc_id, and is dropped from all others;
    what is left keeps its order.  Rows that repeat a doc_id are one document, and so are
    rows without an id, which comes after all ids.  Columns of the three names give way.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text")]
    id_, content, lost, lines = free_names(own, "id", "content", "lost", "lines")
    narrow = docs.select("doc_id", "text")
    listed = staged(listed_lines(narrow, least_length), "lines")
    repeated = staged(repeated_lines(listed, least_documents), "repeated-lines")
    positions = staged(_lost_positions(listed, repeated), "lost-lines").toDF(id_, content, lost)
    rows = docs.select(*own, F.xxhash64("text").alias(f"{content}_row"))
    joined = rows.join(positions, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(f"{content}_row") == F.col(content)), "left")
    # the split text is handed to the lambda as a variable, else each line would split it again
    kept = F.get(F.transform(F.array(F.col(lines)), lambda every: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(lost)), lambda i: F.get(every, i)), "\n")), 0)
    split = joined.withColumn(lines, _lines(F.col("text")))
    return split.select(
        *own, F.size(lines).cast("long").alias("n_lines"),
        F.when(F.col(lost).isNull(), F.lit(0)).otherwise(F.size(lost)).cast("long").alias("n_dropped"),
        F.when(F.col(lost).isNull(), F.coalesce("text", F.lit(""))).otherwise(kept).alias("kept_text"))
