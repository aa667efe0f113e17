"""Token-ID files: ORC stripes of integers with row indexes and Bloom filters on document ids.

Documents are range-partitioned by id, encoded, and written as one row each: its place in
the order, its id, its number of tokens and its token ids, which ORC stores with integer run-length
encoding. A reader takes stripes in parallel; a search for ids skips files and stripes by
their statistics and Bloom filters.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType
from tokenizers import Tokenizer

from matchlake.llm.common import Recent, slices, table
from matchlake.session import ensure_checkpoint_dir

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
}
# Words that a worker keeps twice at most, and the length from which a word is not kept.
CACHED_WORDS, LONG_WORD = 300_000, 64
# What may stand after a word: always tokens of its own after a letter or digit.
STOPS = ".,;:!?%&*$#|"
# Words of small Latin letters, which the vocabulary's normaliser and splitter leave as they are.
SMALL_LETTERS = re.compile("[a-zß-öø-ÿ]+").fullmatch
# Byte-level models write a byte as a printable character: itself, or the next from U+0100 on.
_UNPRINTED = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(_UNPRINTED)}


# The normaliser and splitter of the vocabularies whose texts can be encoded word by word.
KNOWN = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}


class WholeEncoder:
    """Encodes whole texts with the tokenizers library, as any vocabulary allows."""

    def __init__(self, data: bytes):
        self.tokenizer = Tokenizer.from_buffer(data)

    def ids(self, texts: list[str | None], end_id: int) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([text or "" for text in texts], add_special_tokens=False)
        return [np.array([*encoding.ids, end_id], "<u4").tobytes() for encoding in found]


def encoder_of(data: bytes) -> WholeEncoder | WordEncoder:
    """The encoder for a vocabulary file: word by word if its normaliser and splitter are the known ones."""
    known = json.loads(data)
    same = all(known.get(part) == value for part, value in KNOWN.items())
    # A special token must not lie across blanks, nor in a plain word.
    tokens = [token["content"] for token in known["added_tokens"] if not (token["lstrip"] or token["rstrip"])]
    plain = len(tokens) == len(known["added_tokens"]) and all("<" in x and not set(x) & {" ", "\n"} for x in tokens)
    return WordEncoder(data) if same and plain else WholeEncoder(data)


class WordEncoder:
    """Encodes whole texts with the tokenizers library, each different word once; for vocabularies as KNOWN.

    The vocabulary's own splitting never joins what a blank or line feed separates, nor a letter or
    digit with the STOPS after it; special tokens hold neither. So the ids of a text are those of
    its words and stops, one after another. Plain words go to the library's model directly, all
    others through its whole chain.
    """

    def __init__(self, data: bytes):
        self.tokenizer = Tokenizer.from_buffer(data)
        self.tokenize = self.tokenizer.model.tokenize
        self.words = Recent(self._encode, CACHED_WORDS, LONG_WORD)

    def _encode(self, word: str) -> bytes:
        if SMALL_LETTERS(word):
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_LETTERS)
            ids = [token.id for token in self.tokenize(letters)]
            return pack(f"<{len(ids)}I", *ids)
        stem = word.rstrip(STOPS)
        small = stem.lower()
        if SMALL_LETTERS(small):  # then capitals have the ids of small letters
            return self.words[small] + self.words[word[len(stem) :]] if len(stem) < len(word) else self.words[small]
        (encoding,) = self.tokenizer.encode_batch_fast([word], add_special_tokens=False)
        return np.array(encoding.ids, "<u4").tobytes()

    def ids(self, texts: list[str | None], end_id: int) -> list[bytes]:
        """For each text the ids, the end id last, as little-endian 32-bit integers."""
        self.words.age()
        of_word, end = self.words.__getitem__, end_id.to_bytes(4, "little")
        return [b"".join(map(of_word, (text or "").replace("\n", " ").split(" "))) + end for text in texts]


_encoders: dict[bytes, WholeEncoder | WordEncoder] = {}


def encode(spark: SparkSession, path: str, end_id: int) -> Callable[[Column], Column]:
    """A function from a text column to arrays of token ids; null and empty texts have the end id only.

    The driver reads the vocabulary, whose size does not depend on the data, and sends it to all tasks.
    """
    data = spark.sparkContext.broadcast(Path(path).read_bytes())

    @F.arrow_udf(ArrayType(IntegerType()))
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key = hashlib.sha256(data.value).digest()
        if key not in _encoders:  # once a worker
            _encoders.clear()
            _encoders[key] = encoder_of(data.value)
        encoder = _encoders[key]
        for texts in slices(batches):
            found = encoder.ids(texts, end_id)
            ends = np.cumsum([0, *map(len, found)]) // 4
            flat = np.frombuffer(b"".join(found), "<i4")
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    return encoded


@F.arrow_udf(LongType())
def ids_crc32(ids: pa.Array) -> pa.Array:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4", copy=False)
    return pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Write (row_id, doc_id, n_tokens, ids) in ascending order of doc_id to ORC files under `path`.

    row_id ascends in that order; its bits above the 33rd number the file. Rows without id come
    first; rows with the same id follow each other by the hash of their texts, and equal rows
    stay. A null text is an empty one. An empty table gives files without rows. The ranges are
    split by sampled ids, so no range grows with the input.
    """
    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    encoded = ordered.select("doc_id", encode(docs.sparkSession, tokenizer, end_id)(F.col("text")).alias("ids"))
    rows = encoded.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", F.size("ids").alias("n_tokens"), "ids"
    )
    rows.write.mode("errorifexists").options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The stored rows; with `doc_ids` only those, for which whole stripes are skipped unread."""
    stored = spark.read.schema("row_id long, doc_id long, n_tokens int, ids array<int>").orc(path)
    return stored if doc_ids is None else stored.filter(F.col("doc_id").isin(doc_ids))


def with_starts(stored: DataFrame) -> DataFrame:
    """`stored` with start: the number of tokens of all rows before it.

    Only lengths are summed: within each file in its order, and over the files' totals, of which
    there are as many as files.
    """
    part = F.shiftright("row_id", 33)
    totals = stored.groupBy(part.alias("part")).agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("part").orderBy("row_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    rows = stored.withColumn("part", part).withColumn("inside", inside)
    # One row for each file: the bound of what is sent to all tasks.
    rows = rows.join(F.broadcast(totals), "part")
    return rows.withColumn("start", F.col("inside") + F.col("offset")).drop("part", "inside", "offset")


def op9_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    import public_tokenizers

    ensure_checkpoint_dir(spark)
    path = path or f"{spark.sparkContext.getCheckpointDir()}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    stored = read_token_files(spark, path)
    slim = stored.select("row_id", "doc_id", "n_tokens", ids_crc32("ids").alias("ids_crc32"))
    rows = with_starts(slim)
    return rows.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
