"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of paragraph digests. Its sketch has cells that hold, over the digests that fall into them,
a count, the sum of the digests and the sum of their checksums. The sketches of two versions are
subtracted cell by cell, which leaves the digests that differ; peeling recovers them. If too
many differ for the size, a larger sketch is tried. Likeness is the share of common digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh64_intdigest

from matchlake.llm.common import table

# A paragraph: up to eight words, or less up to the end of a sentence or line.
PARAGRAPH = re.compile(r"(?:[^\s.!?]+[^\S\n]*){1,8}[.!?]*|[.!?]+")
HASHES, CELLS, GROWTH = 3, 12, 4
# Salt of repeated paragraphs; those of cells are smaller.
REPEAT = 99
ONE, MINUS_ONE = np.uint64(1), np.uint64(2**64 - 1)
_GOLDEN = 0x9E3779B97F4A7C15
# Digests of each text from which the number of different ones is estimated.
LEAST = 48
_BITS, _LOW = np.uint64(21), np.uint64(0x1FFFFF)
_PARTS = np.arange(HASHES, dtype=np.uint64)[:, None]
_SHIFTS = _PARTS * _BITS


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser: multiplications and shifts, for each salt another one."""
    x = x + np.uint64(salt * _GOLDEN % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Paragraphs:
    """The hashes of a text's paragraphs in order, and where each ends."""

    def __init__(self, text: str, before: Paragraphs | None = None, same: int = 0):
        """`before` is of a text with the same first `same` characters: what ends before them is taken over."""
        n = np.searchsorted(before.ends, same) if before and same else 0
        self.hashes, self.ends = (before.hashes[:n], before.ends[:n]) if n else ([], [])
        new = list(PARAGRAPH.finditer(text, int(self.ends[-1]) if n else 0))
        self.hashes = self.hashes + [xxh3_64_intdigest(m[0].strip().encode("utf-8", "surrogatepass")) for m in new]
        self.ends = np.append(self.ends, [m.end() for m in new]).astype(np.int64)

    @cached_property
    def digests(self) -> np.ndarray:
        """Sorted; the second of equal paragraphs has another digest than the first."""
        keys = np.sort(np.array(self.hashes, np.uint64))
        if not len(keys):
            return keys
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        if len(starts) == len(keys):
            return keys
        repeats = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
        return np.unique(np.where(repeats == 0, keys, mix(keys + repeats.astype(np.uint64), REPEAT)))


def digests(text: str) -> np.ndarray:
    return Paragraphs(text).digests


def places(keys: np.ndarray, size: int, salt: int) -> np.ndarray:
    """The cells of each digest: one in each of HASHES equal parts of the sketch, part after part."""
    part = np.uint64(size // HASHES)
    cells = (mix(keys, salt) >> _SHIFTS & _LOW) * part >> _BITS
    return (cells + _PARTS * part).ravel().astype(np.int64)


def _add(cells: np.ndarray, keys: np.ndarray, signs: np.ndarray | None, salt: int) -> None:
    """Add digests, or with a sign of 2**64 - 1, which stands for -1, take them away. Sums wrap."""
    size = cells.shape[1]
    where = places(keys, size, salt)
    if signs is None:
        rows = np.ones(len(keys), np.uint64), keys, checksum(keys)
    else:
        rows = signs, keys * signs, checksum(keys) * signs
    values = np.concatenate([row for row in rows for _ in range(HASHES)])
    np.add.at(cells.reshape(-1), np.concatenate([where, where + size, where + 2 * size]), values)


def sketch(keys: np.ndarray, size: int = CELLS, salt: int = 0) -> np.ndarray:
    """Cells as columns: how many digests each holds, their sum, and the sum of their checksums."""
    cells = np.zeros((3, size), np.uint64)
    _add(cells, keys, None, salt)
    return cells


def peel(cells: np.ndarray, salt: int = 0) -> tuple[np.ndarray, np.ndarray] | None:
    """The digests only in the first and only in the second of two subtracted sketches, or None if stuck."""
    cells, found, signs, n = cells.copy(), [], [], 0
    while True:
        count, digest, check = cells
        pure = np.flatnonzero((count == ONE) | (count == MINUS_ONE))
        sign = count[pure]
        keys = digest[pure] * sign
        whole = check[pure] == checksum(keys) * sign
        keys, sign = keys[whole], sign[whole]
        if not len(keys):
            break
        order = keys.argsort(kind="stable")  # a digest may be alone in several cells
        keys, sign = keys[order], sign[order]
        first = np.ones(len(keys), bool)
        np.not_equal(keys[1:], keys[:-1], out=first[1:])
        keys, sign = keys[first], sign[first]
        found.append(keys)
        signs.append(sign)
        n += len(keys)
        if n > 2 * cells.shape[1]:  # a false pure cell goes round in circles
            return None
        _add(cells, keys, -sign, salt)
    if cells.any():
        return None
    if not found:
        return digest[:0], digest[:0]
    keys, sign = np.concatenate(found), np.concatenate(signs)
    return keys[sign == ONE], keys[sign == MINUS_ONE]


def expected(a: np.ndarray, b: np.ndarray) -> float:
    """About how many digests differ: as the least of `a`, which are a random part of it, are also in `b` or not."""
    least, n = a[:LEAST], len(a) + len(b)
    if not len(least) or not len(b):
        return n
    found = b[np.minimum(np.searchsorted(b, least), len(b) - 1)] == least
    return n - 2 * found.mean() * len(a)


def difference(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The digests only in `a` and only in `b`.

    The first sketch has nearly two cells for each digest that is expected to differ. Sketches grow by GROWTH, each
    time with other hashes, until one can be peeled; past a size at which all but unlucky ones can,
    the sets are compared directly.
    """
    n = len(a) + len(b)
    size, salt = HASHES * max(CELLS // HASHES, 6 + int(0.6 * expected(a, b)), abs(len(a) - len(b)) // 2), 0
    while size <= 16 * max(n, CELLS):
        found = peel(sketch(a, size, salt) - sketch(b, size, salt), salt)
        if found is not None:
            return found
        size, salt = size * GROWTH, salt + 1
    return np.setdiff1d(a, b), np.setdiff1d(b, a)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common digests over all digests; 1 if neither text has any."""
    only_a, only_b = map(len, difference(a, b))
    union = len(a) + only_b
    return (len(a) - only_a) / union if union else 1.0


def checksum(keys: np.ndarray) -> np.ndarray:
    """Squares: the square of a sum of digests is not the sum of their squares."""
    return keys * keys


def as_text(cells: np.ndarray) -> str:
    return cells.astype("<u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), "<u8").reshape(3, -1)


def edited_text(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many, or all, of the following text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (part, tail, doc_id, tie, packed) in ascending order of doc_id within each of the parts, one to a task.

    The parts are ranges of doc_id, split at quantiles, which are ids that occur. So the first
    row of each part is known by its id before any text moves, and is sent to the part before too, where it
    follows the last one as `tail`; the first of all rows is the tail of the last part. Texts
    cross the shuffle once, compressed. Rows without id come first; those with one id are
    in the order of a hash of their texts.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    cuts, least, n, n_ids = docs.agg(
        F.percentile_approx("doc_id", shares, 100 * parts), F.min("doc_id"), F.count("*"), F.count("doc_id")
    ).first()
    first = None if n > n_ids else least
    cuts = np.array(sorted(set(cuts or []) - {least}), np.int64)

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids = batch["doc_id"].astype("Int64")
            texts = batch["text"].map(lambda x: (x or "").encode("utf-8", "surrogatepass"))
            rows = pd.DataFrame({
                "part": np.searchsorted(cuts, ids.fillna(np.iinfo(np.int64).min).to_numpy(np.int64), side="right"),
                "tail": False,
                "doc_id": ids,
                "tie": [xxh64_intdigest(x) - 2**63 for x in texts],
                "packed": [squeeze(x) for x in texts],
            })
            yield rows
            starts = ids.isna() if first is None else (ids == first).fillna(False)
            before = pd.concat([
                rows[ids.isin(cuts).to_numpy(bool)].eval("part = part - 1"),
                rows[starts.to_numpy(bool)].assign(part=len(cuts)),
            ])
            if len(before):
                yield before.assign(tail=True)

    schema = "part int, tail boolean, doc_id long, tie long, packed binary"
    moved = docs.select("doc_id", "text").mapInPandas(packed, schema)
    dealt = moved.repartitionById(len(cuts) + 1, F.col("part"))
    return dealt.sortWithinPartitions("part", "tail", "doc_id", "tie")


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """One row of RESULT for each row: its fingerprint, that of its edited text, and their likeness.

    The edited text ends with the beginning of the next document by ascending id, after the last of the
    first; a single document follows itself. A null text is an empty one. Each text is
    sketched as a whole; no more than two neighbours are held at once. An empty table gives an empty one.
    """

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_ = zstandard.ZstdDecompressor().decompress
        last, done = None, False  # (doc_id, text, digests) of the row before; whether its part is over
        part = None
        for batch in batches:
            out = []
            for row_part, tail, doc_id, content in zip(batch["part"], batch["tail"], batch["doc_id"].astype("Int64"), batch["packed"]):
                if row_part != part:
                    part, last, done = row_part, None, False
                if done:
                    continue
                text = open_(content).decode("utf-8", "surrogatepass")
                now = doc_id, text, Paragraphs(text)
                if last:
                    out.append(_row(last, now))
                last, done = now, bool(tail)
            if out:
                frame = pd.DataFrame(out, columns=[x.split()[0] for x in RESULT.split(", ")])
                yield frame.astype({"doc_id": "Int64"})

    return in_order(docs).select("part", "tail", "doc_id", "packed").mapInPandas(compared, RESULT)


def _row(own: tuple, following: tuple) -> tuple:
    doc_id, text, paragraphs = own
    edited, same = edited_text(text, following[1]), len(text) - len(text) // 4
    keys, edited_keys = paragraphs.digests, Paragraphs(edited, paragraphs, same).digests
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
        as_text(sketch(keys)),
        as_text(sketch(edited_keys)),
        likeness(keys, edited_keys),
        likeness(keys, following[2].digests),
    )


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_rows(table(spark, sf_dir, "documents"))
