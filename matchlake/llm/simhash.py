"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, cut into `segments` equal parts. Two fingerprints that differ in at most
`max_bits` bits differ in at most max_bits // segments bits of some part. Each part is a hash
table; a small Hamming ball around each part is looked up, and what is found is kept if the whole
distance is small enough. Only distinct fingerprints are looked up, so exact copies cost nothing,
and a fingerprint can have no more neighbours than its ball of 64-bit values.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from matchlake.llm.common import table
from matchlake.llm.components import components
from matchlake.session import ensure_checkpoint_dir

SEED = 42
# Shingles whose bits are counted at once; long texts go block by block.
BLOCK = 1 << 16


def shingle_hashes(text: str | None, shingle: int, block: int) -> Iterator[np.ndarray]:
    """The XXH64 of each shingle, as unsigned numbers, in blocks."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    starts = [0, *ends]
    last = ends[min(shingle, len(words)) - 1 :] if words else []
    for at in range(0, len(last), block):
        pairs = zip(starts[at : at + block], last[at : at + block])
        yield np.frombuffer(b"".join(xxh64_digest(joined[a : b - 1], SEED) for a, b in pairs), ">u8").astype(np.uint64)


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint as a signed 64-bit number; zero for a text without words."""
    ones, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, shingle, BLOCK):
        n += len(hashes)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(shingle: int = 3) -> Callable[[Column], Column]:
    """A function from a text column to its fingerprints as longs.

    A-Z in lower case, words apart at ASCII white space, shingles of `shingle` words with repeats; a
    text of fewer words is one shingle. Null, empty and blank texts have fingerprint zero.
    """

    @F.pandas_udf("long")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(text, shingle) for text in texts], dtype="int64")

    return fingerprints


def links(prints: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """(a, b) with a < b or b < a, once for each two different fingerprints at most max_bits apart.

    `prints` has distinct values in the column `print`. The balls have radius 0 or 1, so max_bits // segments must
    be at most 1. Of two parts that differ in one bit only the one with that bit at zero is
    the centre of a ball that is looked up, so no pair is found twice in a table; one that an
    earlier table finds too is left to that one.
    """
    radius, width = max_bits // segments, 64 // segments
    if radius > 1 or 64 % segments or segments < 2:
        raise ValueError("segments must divide 64, be two at least and more than half of max_bits")

    def part(fingerprint: Column, number: int) -> Column:
        return F.shiftrightunsigned(fingerprint, width * number).bitwiseAND(F.lit((1 << width) - 1))

    def keyed(make: Callable[[int], list[Column]]) -> DataFrame:
        rows = [F.struct(F.lit(n).alias("segment"), key.alias("key")) for n in range(segments) for key in make(n)]
        exploded = prints.select("print", F.explode(F.array(*rows)).alias("at"))
        return exploded.select("print", "at.segment", "at.key").filter("key IS NOT NULL")

    def ball(number: int) -> list[Column]:
        own = part(F.col("print"), number)
        near = [F.when(own.bitwiseAND(F.lit(1 << bit)) == 0, own + F.lit(1 << bit)) for bit in range(width)]
        return [own, *(near if radius else [])]

    tables = keyed(lambda n: [part(F.col("print"), n)]).withColumnRenamed("print", "b")
    found = keyed(ball).withColumnRenamed("print", "a").join(tables, ["segment", "key"])
    differ = F.col("a").bitwiseXOR(F.col("b"))
    own_part = F.lit(None).cast("long")
    earlier = F.lit(False)
    for n in range(segments):
        own_part = F.when(F.col("segment") == n, part(differ, n)).otherwise(own_part)
        earlier = earlier | ((F.col("segment") > n) & (F.bit_count(part(differ, n)) <= radius))
    once = (own_part != 0) | (F.col("a") < F.col("b"))
    return found.filter(F.bit_count(differ).between(1, max_bits) & once & ~earlier).select("a", "b")


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """(doc_id, print, component_id) for each row of the documents.

    component_id is the smallest id that can be reached over links, its own included. Rows with the
    same text share a fingerprint and so a component, repeated rows too. A row
    without id is kept and can connect others, but names no component unless none of them has
    an id (then component_id is null). An empty table gives an empty one. Other columns are ignored.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    prints = docs.select("doc_id", fingerprint(shingle)(F.col("text")).alias("print")).checkpoint()
    smallest = prints.groupBy("print").agg(F.min("doc_id").alias("first_id")).checkpoint()
    linked = components(links(smallest.select("print"), max_bits, segments))
    of_print = smallest.join(linked, F.col("print") == F.col("node"), "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    named = of_print.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = of_print.join(named, "root").select("print", "component_id")
    return prints.join(named, "print").select("doc_id", "print", "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
