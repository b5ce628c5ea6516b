"""Token ids in ORC.

Documents go to files in order of their ids; a row is a document's token ids with its
place in the file.  ORC packs the ids by integer run-length encoding in stripes that
tasks read apart; row indexes and Bloom filters on ``doc_id`` let a reader that wants
some documents skip all other stripes and row groups.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from swinglake.llm.common import give_back

END_ID = 1
ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
_PUNCTUATION = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"      # ASCII marks that end no special token
_CACHE = 345_000      # entries a generation, just below where a dict doubles its table; bounds a worker's memory, not what is encoded
_TEXT_BYTES = 4 << 20      # of texts whose distinct words are looked up together
_BATCH_BYTES = 4 << 20      # of ids handed on at once
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_MARKS = frozenset("ªº")      # letters by name only
_plain = re.compile("[a-zß-öø-ÿ]+").fullmatch      # lower-case letters, composed as they are
_LETTERS = frozenset(c for c in map(chr, range(256)) if c.isalpha()) - _MARKS
_PARTS = f"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[{re.escape(_PUNCTUATION)}]*)$"


class WordEncoder(dict):
    """White-space separated word -> its ids as little-endian bytes.

    The tokenizer drops white space and never joins text across it, so a text's ids
    are those of its words.  Likewise a letter or digit and the marks after it are
    tokens apart, and case does not count.  Such parts are words themselves, so one cache
    holds both.  It has two generations: a full one is kept until the next is full, and
    what is met again meanwhile moves on.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.older: dict[str, bytes] = {}
        # the model reads bytes spelled as characters; the tokenizer itself says how
        self.spelling = {ord(c): self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0]
                         for c in _LETTERS if c == c.lower() and not c.isascii()}
        self.ends = _LETTERS | frozenset("0123456789")

    def encode(self, text: str) -> bytes:
        if any(c in text for c in _SEPARATORS):      # white space to Python, not to the tokenizer
            return self._ids(text)
        return b"".join(map(self.__getitem__, text.split()))

    def encode_all(self, texts: pa.Array, end: bytes) -> tuple[pa.Buffer, np.ndarray]:
        """Ids of all texts one after the other, each followed by ``end``; and where, in ids, each text ends.

        A distinct word is looked up once, and its ids are copied to all its places.
        """
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, f"[{_SEPARATORS}]")
        lists = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        words = lists.flatten().dictionary_encode()
        wholes = [self._ids(t) for t in texts.filter(odd).to_pylist()]
        known = pa.concat_arrays([self._distinct(words.dictionary), pa.array([end, *wholes], pa.large_binary())])
        # after a text's words: the ids of the text as a whole, if it was not split, then the end
        odd, n = odd.to_numpy(zero_copy_only=False), len(words.dictionary)
        ends, last = np.cumsum(pc.list_value_length(lists).to_numpy()), np.cumsum(1 + odd)
        more = np.full(last[-1], n)
        more[last[odd] - 2] = n + 1 + np.arange(len(wholes))
        places = np.insert(words.indices.to_numpy(), np.repeat(ends, 1 + odd), more)
        taken = known.take(pa.array(places))
        return taken.buffers()[2], np.frombuffer(taken.buffers()[1], dtype=np.int64)[ends + last] // len(end)

    def _distinct(self, words: pa.Array) -> pa.Array:
        """The ids of each word; letters that are followed by different marks, or in another case, are looked up once."""
        def of(part: pa.Array) -> pa.Array:
            distinct = part.dictionary_encode()
            texts = distinct.dictionary.to_numpy(zero_copy_only=False).tolist()      # to_pylist is slower
            return pa.array(list(map(self.__getitem__, texts)), pa.large_binary()).take(distinct.indices)

        parts = pc.extract_regex(words, _PARTS)
        letters, marks = of(pc.utf8_lower(pc.struct_field(parts, "letters"))), of(pc.struct_field(parts, "marks"))
        joined = pc.binary_join_element_wise(letters, marks, pa.scalar(b"", pa.large_binary()))
        return pc.replace_with_mask(joined, joined.is_null(), of(words.filter(joined.is_null())))

    def _ids(self, text: str) -> bytes:
        return array("i", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _letters(self, piece: str) -> bytes:
        spelt = piece if piece.isascii() else piece.translate(self.spelling)
        return array("i", [x.id for x in self.model.tokenize(spelt)]).tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None and _plain(word):
            ids = self._letters(word)
        elif ids is None:
            base = word.rstrip(_PUNCTUATION)
            if base and base[-1] in self.ends:
                # special tokens are found in a text as it is written
                piece = base.lower() if (base.isascii() or max(base) < "Ā") and "<|" not in base else base
            else:
                base = piece = word
            ids = self._ids(piece) if piece == word else self[piece]
            if len(base) < len(word):
                ids += self[word[len(base):]]
        if len(self) >= _CACHE:
            self.older = dict(self)
            self.clear()
        self[word] = ids
        return ids


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _cuts(ends: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows, by where each ends, of about the same size that hold ``most`` together or are one row."""
    first, total = 0, int(ends[-1]) if len(ends) else 0
    most = -(-total // max(1, -(-total // most)))
    while first < len(ends):
        before = ends[first - 1] if first else 0
        upto = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield first, upto
        first = upto


def encode_frame(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id, shard, shard_start, n_tokens, ids``: documents in id order, ids ending with ``end_id``.

    ``shard`` is the partition, ``shard_start`` counts its ids before the document.
    """
    ordered = (docs.select("doc_id", "text", F.xxhash64("text").alias("_tie"))
               .repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
               .select("doc_id", F.spark_partition_id().alias("shard"), "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, start = _encoder(tokenizer), np.array([end_id], dtype="<i4").tobytes(), 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
            for first, upto in _cuts(np.cumsum(lengths, dtype=np.int64), _TEXT_BYTES):
                some = batch.slice(first, upto - first)
                ids, ends = words.encode_all(some.column(2), end)
                for a, b in _cuts(ends, _BATCH_BYTES // len(end)):
                    before = int(ends[a - 1]) if a else 0
                    offsets = np.append(before, ends[a:b]) - before
                    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, ids.slice(len(end) * before)])
                    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
                    yield pa.RecordBatch.from_arrays(
                        [some.column(0).slice(a, b - a), some.column(1).slice(a, b - a), pa.array(start + offsets[:-1]),
                         pa.array(np.diff(offsets)), lists], names=["doc_id", "shard", "shard_start", "n_tokens", "ids"])
                    start += int(offsets[-1])
        give_back()

    kind = dict(docs.dtypes)["doc_id"]
    return ordered.mapInArrow(encode, f"doc_id {kind}, shard int, shard_start long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Writes ``encode_frame`` as ORC.  A null text is empty; rows with equal ids are kept, by text hash;
    rows without id come first.  Other columns of ``docs`` play no part."""
    encode_frame(docs, tokenizer, end_id).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The table as written; with ``doc_ids`` only these, found by row indexes and Bloom filters."""
    stored = spark.read.orc(path)
    return stored if doc_ids is None else stored.where(F.col("doc_id").isin(doc_ids))


def shard_offsets(stored: DataFrame) -> DataFrame:
    """``shard, shard_offset``: ids before each file.  A row per file goes through one window."""
    sizes = stored.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    before = F.sum("_n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    return sizes.select("shard", before.alias("shard_offset"))


def digests(stored: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the stored ids."""
    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(values)).cast("B")
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            counts = np.diff(ends).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(counts), pa.array(sums, pa.int64())],
                names=["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"])

    kind = dict(stored.dtypes)["doc_id"]
    summed = stored.select("doc_id", "shard", "shard_start", "ids").mapInArrow(
        crc, f"doc_id {kind}, shard int, shard_start long, n_tokens long, ids_crc32 long")
    return summed.join(shard_offsets(stored), "shard").select(
        "doc_id", (F.col("shard_offset") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")
