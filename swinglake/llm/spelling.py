"""Grouping of spelling variants with a bit-sliced position index.

Words are counted over all texts.  Two words one edit apart agree in all letters but those
of one half, so words meet in buckets of equal length and equal other half; a bucket that is too
large is cut anew with smaller pieces to differ in, down to single letters.  Buckets are
packed into blocks of some thousand words.  A block keeps, for every position and letter,
a bitset over its words; reading a query word letter by letter, word-parallel recurrences
over these bitsets hold the words that agree so far and those that agree but for one replaced
or one inserted letter, the latter by bitsets of the next position.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swinglake.llm.common import staged

LEAST_LENGTH, LEAST_COUNT = 6, 5
RATIO = 5              # a form is so many times as frequent as its variant
MODULUS = 199          # runs whose hash this divides lose a letter
BLOCK = 4_000          # words of up to WIDE letters in a block, about; a larger bucket is cut anew
WIDE = 64              # words of more letters count so many times more
QUERIES = 512          # words that go through a block at a time
HELD = 300_000         # counts that a task keeps before it hands them on

_runs = re.compile("[a-zÀ-ÿ]+").findall


def _seen_in(doc_id: str, text: bytes, least_length: int) -> Iterator[tuple[str, int]]:
    """Words of a text with their counts, after the deletions; too short ones are left out."""
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(_runs(text.lower().decode("utf-8", "replace"))).items():
        if len(run) >= least_length:
            h = zlib.crc32(run.encode(), start)
            if h % MODULUS == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < least_length:
                    continue
            yield run, n


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: words of at least so many code points and occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                for word, n in _seen_in(doc_id.as_py(), text.as_py(), least_length):
                    held[word] += n
                if len(held) >= HELD:
                    yield flush()
        yield flush()

    texts = docs.where("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text").cast("binary").alias("text"))
    return (texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# --- buckets ---------------------------------------------------------------

def _in_buckets(words: DataFrame) -> DataFrame:
    """``word, length, first, last, key``: words by the letters they must share with a partner.

    ``length`` is that of the shorter of two partners: each word stands with its own length
    and, as the longer one, with one letter less.  The partners differ in letters ``first`` up to
    ``last`` of the shorter one, at first one of its halves, and ``key`` hashes all others.
    """
    size = F.char_length("word")
    lengths = words.select("word", F.explode(F.array(size, size - 1)).alias("length")).where("length > 0")
    half = F.floor(F.col("length") / 2).cast("int")
    halves = F.explode(F.array(F.struct(F.lit(0).alias("first"), half.alias("last")),
                               F.struct(half.alias("first"), F.col("length").alias("last"))))
    return _keyed(lengths.select("word", "length", halves.alias("piece")).select("word", "length", "piece.*"))


def _keyed(rows: DataFrame) -> DataFrame:
    kept = F.struct(F.col("length"), F.col("first"), F.expr("left(word, first)"), F.expr("right(word, length - last)"))
    return rows.select("word", "length", "first", "last", F.xxhash64(kept).alias("key"))


def _cut(rows: DataFrame) -> DataFrame:
    """The rows with each piece in two."""
    middle = F.floor((F.col("first") + F.col("last")) / 2).cast("int")
    pieces = F.explode(F.array(F.struct(F.col("first"), middle.alias("last")),
                               F.struct(middle.alias("first"), F.col("last"))))
    return _keyed(rows.select("word", "length", pieces.alias("piece")).select("word", "length", "piece.*"))


def _weight() -> Column:
    return F.greatest(F.lit(1.0), F.col("length") / WIDE)


def _bounded_buckets(words: DataFrame, block: int) -> DataFrame:
    """``word, length, key`` in buckets of more than one word and at most ``block``, or with one letter to differ in.

    Each turn halves the pieces, so there are no more turns than the longest word has binary digits.
    """
    rows, done = _in_buckets(words), None
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
        sized = staged(rows.join(sizes, "key"), "buckets")
        large = (F.col("members") * _weight() > block) & (F.col("last") - F.col("first") > 1)
        small = sized.where(~large).select("word", "length", "key")
        done = small if done is None else done.unionByName(small)
        rows = sized.where(large).drop("members")
        if rows.isEmpty():
            return done
        rows = _cut(rows)


# --- the index -------------------------------------------------------------

class PositionIndex:
    """For every (position, letter) the set of words with that letter there, as bits."""

    def __init__(self, words: list[str]):
        self.words = words
        self.chunks = -(-len(words) // 64)
        width = max(map(len, words), default=0)
        letters = np.zeros((len(words), width + 2), np.uint32)
        for row, word in enumerate(words):
            letters[row, :len(word)] = np.frombuffer(word.encode("utf-32-le"), np.uint32)
        self.alphabet, place = np.unique(letters, return_inverse=True)
        self.codes = place.reshape(letters.shape)
        # slices[i, c]: words with letter c at position i; letter 0 stands for the end
        self.slices = np.zeros((width + 2, len(self.alphabet), self.chunks), np.uint64)
        rows, bit = np.arange(len(words)) // 64, np.uint64(1) << (np.arange(len(words), dtype=np.uint64) % np.uint64(64))
        for i in range(width + 2):
            np.bitwise_or.at(self.slices[i], (self.codes[:, i], rows), bit)

    def _of_length(self, length: int) -> np.ndarray:
        bits = np.zeros(self.chunks * 64, np.uint8)
        bits[[i for i, w in enumerate(self.words) if len(w) == length]] = 1
        return np.packbits(bits, bitorder="little").view(np.uint64)

    def near(self, length: int, queries: int = QUERIES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, row): a word of ``length`` and one of the same length with one letter replaced, or
        with one letter more."""
        same, longer = self._of_length(length), self._of_length(length + 1)
        asked = np.array([i for i, w in enumerate(self.words) if len(w) == length], dtype=np.int64)
        for at in range(0, len(asked), queries):
            rows = asked[at:at + queries]
            exact = np.full((len(rows), self.chunks), ~np.uint64(0))
            replaced, inserted = np.zeros_like(exact), np.zeros_like(exact)
            for i in range(length):
                letter = self.codes[rows, i]
                here, shifted = self.slices[i, letter], self.slices[i + 1, letter]
                inserted = (inserted | exact) & shifted
                replaced = (replaced & here) | (exact & ~here)
                exact &= here
            found = (replaced & same) | ((inserted | exact) & longer)
            query, chunk = np.nonzero(found)
            bits = np.unpackbits(found[query, chunk].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            pair, bit = np.nonzero(bits)
            yield rows[query[pair]], chunk[pair] * 64 + bit


def _pairs_of_block(frame: pd.DataFrame) -> pd.DataFrame:
    """Near pairs of a block, whose words have ``length`` or one letter more."""
    words = sorted(set(frame["word"]))
    index = PositionIndex(words)
    found = [np.array(pair) for pair in index.near(int(frame["length"].iat[0]))]
    pairs = np.concatenate([np.empty((2, 0), np.int64), *found], axis=1)
    named = np.array(words, dtype=object)
    return pd.DataFrame({"u": named[pairs[0]], "v": named[pairs[1]]})


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, near``: all words of ``word`` (distinct) one inserted, deleted or replaced code point apart, both ways."""
    rows = staged(_bounded_buckets(words.select("word"), block), "words-in-buckets")
    blocks = rows.groupBy("length").agg(F.ceil(F.sum(_weight()) / block).alias("blocks"))
    dealt = rows.join(blocks, "length").select(
        "word", "length", F.pmod(F.xxhash64("key"), F.col("blocks")).alias("block"))
    pairs = dealt.groupBy("length", "block").applyInPandas(_pairs_of_block, "u string, v string")
    both = F.explode(F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("near")),
                             F.struct(F.col("v").alias("word"), F.col("u").alias("near"))))
    return pairs.select(both.alias("pair")).select("pair.*").distinct()


def _roots(forms: DataFrame, largest: int) -> DataFrame:
    """``word, root``: where the ``form`` of each word leads to, by doubling the steps.

    Every step multiplies the count by ``RATIO`` at least, so the largest count bounds the steps.
    """
    steps, reach = 1, largest
    while reach >= RATIO:
        steps, reach = steps + 1, reach // RATIO
    now = staged(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    covered = 1
    while covered < steps:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = staged(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        covered *= 2
    return now


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
             block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: every word of the texts, and what it is a variant of.

    Words are runs of ``A-Z``, ``a-z`` and U+00C0 to U+00FF, with A-Z in lower case; one whose CRC-32
    after ``<doc_id>:`` the modulus divides loses a code point.  Kept are words of ``least_length`` and
    seen ``least_count`` times.  Near words are one inserted, deleted or replaced code point apart; a
    word's ``form`` is the most frequent of them (ties: the first by code points) when it is ``RATIO``
    times as frequent, and ``root`` is where forms lead to in the end.  Null and empty texts have
    no words, a null doc_id is the empty text, repeated rows count each; other columns play no part.
    """
    words = staged(word_counts(docs.select("doc_id", "text"), least_length, least_count), "vocabulary")
    pairs = near_pairs(words, block).join(
        words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = pairs.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    judged = words.join(best, "word", "left").withColumn(
        "formed", F.col("best").isNotNull() & (-F.col("best.order") >= RATIO * F.col("n")))
    forms = staged(judged.select(
        "word", F.when(F.col("formed"), F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("formed"), -F.col("best.order")).alias("form_n")), "forms")
    largest = words.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    return (forms.join(_roots(forms, largest), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
