"""Conversations without quotes, by quotation linking; DataFrame operations only.

A message's lines are cut into passages of one quote level.  Normalised passages and lines
are hashed and joined to the first message of the conversation that says them itself; the
message quoted at the lowest level is the one replied to.  Replies make a tree below
the conversation's first message, and its branches give the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import staged
from swinglake.operators.numbering import with_row_number

MIN_WORDS = 3      # a line of fewer words is no sign of its origin; a whole passage is
_MARK = r"'^(?:[ \\t]*>)++[ \\t]?'"
_SAID = r"'(?i)^\\s*on\\b.{1,300}\\bwrote:\\s*$'"


def _normal(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '\\\\s+', ' '))"


def passages(messages: DataFrame) -> DataFrame:
    """``messages`` with ``_own``, what the sender says, and ``_passages`` (``level``, ``lines``), all levels in order.

    A line's level is the number of ``>`` before it.  Lines that announce a quote
    ("On ... wrote:") go where a message has any.
    """
    marked = messages.withColumn("_text", F.coalesce("text", F.lit(""))).withColumn(
        "_lines", F.expr(f"""transform(split(_text, '\\r?\\n', -1), l -> named_struct(
            'level', length(regexp_replace(regexp_extract(l, {_MARK}, 0), '[^>]', '')),
            'line', regexp_replace(l, {_MARK}, '')))"""))
    quoting = marked.withColumn("_lines", F.expr(
        f"""CASE WHEN exists(_lines, l -> l.level > 0)
            THEN filter(_lines, l -> l.level > 0 OR NOT l.line rlike {_SAID}) ELSE _lines END"""))
    starts = quoting.withColumn("_starts", F.expr(
        """filter(sequence(0, greatest(size(_lines) - 1, 0)),
                  i -> i = 0 OR get(_lines, i).level <> get(_lines, i - 1).level)"""))
    cut = starts.withColumn("_passages", F.expr(
        """CASE WHEN size(_lines) = 0 THEN cast(array() AS array<struct<level: int, lines: array<string>>>)
           ELSE transform(_starts, (s, i) -> named_struct('level', get(_lines, s).level, 'lines',
               transform(slice(_lines, s + 1, coalesce(get(_starts, i + 1), size(_lines)) - s), l -> l.line))) END"""))
    own = "array_join(flatten(transform(filter(_passages, p -> p.level = 0), p -> p.lines)), '\\n')"
    return cut.withColumn("_own", F.expr(f"trim(BOTH ' \\t\\r\\n' FROM {own})")).drop("_lines", "_starts", "_text")


def _units(passage: str) -> str:
    """Hashes of a passage: of the whole, and of its lines with enough words."""
    lines = f"filter(transform({passage}, l -> {_normal('l')}), l -> size(split(l, ' ')) >= {MIN_WORDS})"
    return f"array_distinct(transform(array_append({lines}, {_normal(f'array_join({passage}, chr(32))')}), u -> md5(u)))"


def replies(cut: DataFrame) -> DataFrame:
    """``conv_id, turn, reply_to, n_linked``: the earlier message that a message quotes, by ``passages``.

    Of several the one quoted at the lowest level, then in most passages, then the
    latest.  What a hash leads to is one message, so no group meets itself.
    """
    said = cut.where("conv_id IS NOT NULL AND turn IS NOT NULL AND _own <> ''")
    whole = F.expr(f"array_union({_units('split(_own, chr(10))')}, "
                   f"flatten(transform(filter(_passages, p -> p.level = 0), p -> {_units('p.lines')})))")
    first = (said.select("conv_id", F.col("turn").alias("said_at"), F.explode(whole).alias("unit"))
             .groupBy("conv_id", "unit").agg(F.min("said_at").alias("said_at")))
    quoted = (cut.where("conv_id IS NOT NULL AND turn IS NOT NULL")
              .select("conv_id", "turn", F.explode(F.expr("filter(_passages, p -> p.level > 0)")).alias("p"))
              .select("conv_id", "turn", "p.level", F.explode(F.expr(_units("p.lines"))).alias("unit")).distinct())
    found = quoted.join(first, ["conv_id", "unit"]).where("said_at < turn")
    votes = found.groupBy("conv_id", "turn", "level", "said_at").agg(F.count("*").alias("n"))
    best = F.max(F.struct((-F.col("level")).alias("near"), "n", "said_at"))
    return votes.groupBy("conv_id", "turn").agg(best.alias("best"), F.sum("n").alias("n_linked")).select(
        "conv_id", "turn", F.col("best.said_at").alias("reply_to"), "n_linked")


def branches(nodes: DataFrame) -> DataFrame:
    """``conv_id, turn, branch, depth`` for ``nodes`` (``conv_id, turn, reply_to, first``), a row per message.

    ``branch`` is the ancestor right below the first message.  Each round doubles how far
    up a message has looked, so rounds grow with the logarithm of the longest chain.
    """
    root = F.col("turn") == F.col("first")
    below = F.col("reply_to") == F.col("first")
    at = staged(nodes.select(
        "conv_id", "turn", (root | below).alias("done"), F.when(root | below, F.col("turn")).otherwise(F.col("reply_to")).alias("branch"),
        F.when(root, 0).otherwise(1).cast("long").alias("depth")), "branches")
    while at.where("NOT done").limit(1).count():
        up = at.select("conv_id", F.col("turn").alias("branch"), F.col("branch").alias("_up"),
                       F.col("depth").alias("_more"), F.col("done").alias("_done"))
        open_ = at.where("NOT done").join(up, ["conv_id", "branch"]).select(
            "conv_id", "turn", F.col("_done").alias("done"), F.col("_up").alias("branch"), (F.col("depth") + F.col("_more")).alias("depth"))
        at = staged(at.where("done").unionByName(open_), "branches")
    return at.select("conv_id", "turn", "branch", "depth")


def conversations(messages: DataFrame) -> DataFrame:
    """``conv_id, position, turn, role, reply_to, depth, branch, n_quotes, n_linked, text``: a row per message.

    ``text`` is without quotes.  ``position`` (from 1) is the place in reply order: the first
    message, then branch after branch, each by turn, so that what is answered comes before
    its answers.  A message that links to nothing replies to the first one.  A message
    without conversation or turn stands alone.  Messages with one turn share their place in the tree and
    are ordered by text; repeated rows stay.  A null text is empty; other columns play no part.
    """
    cut = staged(passages(messages.select("conv_id", "turn", "role", "text")).select(
        "conv_id", "turn", "role", F.col("_own"), "_passages"), "passages")
    placed = cut.where("conv_id IS NOT NULL AND turn IS NOT NULL")
    first = placed.groupBy("conv_id").agg(F.min("turn").alias("first"))
    nodes = (placed.select("conv_id", "turn").distinct().join(first, "conv_id")
             .join(replies(cut), ["conv_id", "turn"], "left")
             .withColumn("reply_to", F.when(F.col("turn") > F.col("first"), F.coalesce("reply_to", "first"))))
    nodes = staged(nodes, "replies")
    tree = nodes.select("conv_id", "turn", "reply_to", "n_linked").join(branches(nodes), ["conv_id", "turn"])
    quotes: Column = F.expr("size(filter(_passages, p -> p.level > 0))")
    columns = ["conv_id", "turn", "role", "reply_to", "depth", "branch", "n_quotes", "n_linked", "text"]
    joined = (placed.join(tree, ["conv_id", "turn"]).withColumn("n_quotes", quotes)
              .withColumn("n_linked", F.coalesce("n_linked", F.lit(0))).withColumn("text", F.col("_own")).select(*columns))
    ordered = with_row_number(joined, "conv_id", ["branch", "turn", "text", "role"], "position")
    alone = cut.where("conv_id IS NULL OR turn IS NULL").select(
        "conv_id", "turn", "role", F.lit(None).cast("long").alias("reply_to"), F.lit(0).cast("long").alias("depth"),
        F.col("turn").alias("branch"), quotes.alias("n_quotes"), F.lit(0).cast("long").alias("n_linked"),
        F.col("_own").alias("text"), F.lit(1).cast("long").alias("position"))
    return ordered.unionByName(alone).select("conv_id", "position", *columns[1:])
