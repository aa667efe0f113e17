"""Language-model scores with stupid backoff, computed relationally.

The corpus' n-grams of one to `order` words are counted in tables partitioned by n-gram hash, the counts
are joined to the n-grams of each block of documents, and the scores are summed per document. The
counts of a document's own n-grams are left out, so a text is scored by the rest of the corpus.

Rows of both relations are packed: one row holds all n-grams of one block that fall into one
partition of the count tables, as sorted hashes with their counts. A block is a set of documents
chosen by hash, of about `block_chars` characters; n-grams are counted in the block before anything is
shuffled, so a very frequent one costs one entry for each block. The answer to a packed row has the corpus counts
in the same order, so it needs no hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from matchlake.llm.common import table

# Bits of an n-gram's hash. Among 10 ** 12 different n-grams one in 70,000 shares its hash with another.
HASH_BITS = 56
BACKOFF = 0.4
BLOCK_CHARS = 8_000_000
# n-grams of the corpus, with repeats, for each partition of the count tables.
PARTITION_GRAMS = 1_000_000
# The key under which each block counts its words; n-grams do not get it.
ALL_WORDS = np.uint64(0)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def words_of(text: str | None) -> list[bytes]:
    """A-Z in lower case, words apart at ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def gram_hashes(words: list[bytes], order: int) -> list[np.ndarray]:
    """For each length up to `order` the hashes of the n-grams, by the place of their first word."""
    single = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    raw, out = single, []
    for n in range(1, order + 1):
        if n > 1:
            raw = (raw[:-1] ^ (raw[:-1] >> np.uint64(29))) * _A + single[n - 1 :]
            raw = (raw ^ (raw >> np.uint64(32))) * _B
        hashed = (raw ^ (raw >> np.uint64(31))) * _A >> np.uint64(64 - HASH_BITS)
        out.append(np.where(hashed == ALL_WORDS, np.uint64(1), hashed))
    return out


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers, byte by byte of equal weight, compressed."""
    columns = values.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(columns).tobytes(), 1)


def unpack(packed: bytes) -> np.ndarray:
    columns = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(columns.T).view("<u8").ravel()


class Block:
    """The n-grams of a block's documents: `keys` sorted, with counts; where each document's are among them."""

    def __init__(self, texts: list[str | None], order: int):
        self.sizes, grams = [], [np.array([ALL_WORDS])]
        for text in texts:
            words = words_of(text)
            self.sizes.append(len(words))
            grams += gram_hashes(words, order) if words else []
        self.order = order
        every = np.concatenate(grams)
        self.keys, self.where, counts = np.unique(every, return_inverse=True, return_counts=True)
        self.counts = counts.astype(np.uint64)
        self.counts[self.keys == ALL_WORDS] = sum(self.sizes)

    def documents(self) -> Iterator[list[np.ndarray]]:
        """For each document, for each length, the places of its n-grams in `keys`."""
        at = 1
        for size in self.sizes:
            parts = []
            for n in range(1, self.order + 1):
                length = max(size - n + 1, 0) if size else 0
                parts.append(self.where[at : at + length])
                at += length
            yield parts

    def scores(self, totals: np.ndarray) -> list[tuple]:
        """(n_words, n_seen of each length from the longest, log_score) for each document."""
        everywhere = int(totals[self.keys == ALL_WORDS][0])
        return [self._score(parts, totals, everywhere) for parts in self.documents()]

    def _score(self, parts: list[np.ndarray], totals: np.ndarray, everywhere: int) -> tuple:
        n_words = len(parts[0])
        others = [self._elsewhere(part, totals) for part in parts]
        rest = max(everywhere - n_words, 1)
        best = np.full(n_words, -1, np.int64)  # the length that was seen elsewhere, 0 for an unseen word
        logs = np.empty(n_words)
        for length in range(self.order, 0, -1):
            seen = np.zeros(n_words, np.int64)
            seen[length - 1 :] = others[length - 1][: max(n_words - length + 1, 0)]
            below = np.full(n_words, rest, np.int64)
            if length > 1 and n_words >= length:
                below[length - 1 :] = others[length - 2][: n_words - length + 1]
            new = (best < 0) & (seen > 0)
            # A word at the start has a shorter context to begin with: backing off counts from there.
            steps = np.minimum(self.order, np.arange(1, n_words + 1)) - length
            logs[new] = np.log(seen[new] / below[new]) + steps[new] * math.log(BACKOFF)
            best[new] = length
        unseen = best < 0
        steps = np.minimum(self.order, np.arange(1, n_words + 1))
        logs[unseen] = math.log(1 / rest) + (steps[unseen] - 1) * math.log(BACKOFF)
        return n_words, [int((best == n).sum()) for n in range(self.order, 0, -1)], float(logs.sum())

    def _elsewhere(self, part: np.ndarray, totals: np.ndarray) -> np.ndarray:
        """Counts of n-grams without those of the document itself."""
        _, which, own = np.unique(part, return_inverse=True, return_counts=True)
        return totals[part].astype(np.int64) - own[which]


def backoff_scores(docs: DataFrame, order: int = 3, block_chars: int = BLOCK_CHARS, partition_grams: int = PARTITION_GRAMS) -> DataFrame:
    """(doc_id, n_words, n_seen, log_score) for each row.

    A word is scored by its longest n-gram, of at most `order` words, that occurs outside the document: by its count
    over that of its context, both outside the document, times BACKOFF for each word of
    context given up. A word that occurs nowhere else scores as if it occurred once. n_seen has the number of words
    scored by each length, the longest first. log_score is the sum of natural logarithms; a null or empty
    text, or one without words, has no words and score 0. Repeated rows are documents of their own, and each other's corpus; rows
    without id are scored too. An empty table gives an empty one.
    """
    n_chars = docs.agg(F.sum(F.length("text").cast("long") + 1)).first()[0] or 0
    n_blocks = max(1, math.ceil(n_chars / block_chars))
    bits = max(0, math.ceil(math.log2(max(n_chars, 1) / 6 * order / partition_grams)))
    rows = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block"), "doc_id", "text"
    )

    def grams(batch: pd.DataFrame) -> pd.DataFrame:
        block = Block(batch["text"].tolist(), order)
        part = (block.keys >> np.uint64(HASH_BITS - bits)).astype(np.int64)
        parts, starts = np.unique(part, return_index=True)
        out = []
        for number, a, b in zip(parts, starts, [*starts[1:], len(part)]):
            gaps = np.diff(block.keys[a:b], prepend=np.uint64(0))
            out.append((int(batch["block"].iloc[0]), number, pack(gaps), pack(block.counts[a:b])))
        return pd.DataFrame(out, columns=["block", "part", "keys", "counts"])

    def corpus_counts(batch: pd.DataFrame) -> pd.DataFrame:
        asked = [np.cumsum(unpack(x), dtype=np.uint64) for x in batch["keys"]]
        keys, where = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.concatenate([unpack(x) for x in batch["counts"]]).astype(np.int64)
        totals = np.zeros(len(keys), np.int64)
        np.add.at(totals, where, counts)
        answers = np.split(totals[where], np.cumsum([len(x) for x in asked])[:-1])
        return pd.DataFrame({"block": batch["block"], "part": batch["part"], "totals": [pack(x) for x in answers]})

    def scored(texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block = Block(texts["text"].tolist(), order)
        totals = np.concatenate([unpack(x) for x in answers.sort_values("part")["totals"]])
        out = pd.DataFrame(block.scores(totals), columns=["n_words", "n_seen", "log_score"])
        out.insert(0, "doc_id", texts["doc_id"].astype("Int64").to_numpy())
        return out

    asked = rows.groupBy("block").applyInPandas(grams, "block int, part int, keys binary, counts binary")
    answered = asked.groupBy("part").applyInPandas(corpus_counts, "block int, part int, totals binary")
    cogrouped = rows.groupBy("block").cogroup(answered.groupBy("block"))
    return cogrouped.applyInPandas(scored, "doc_id long, n_words long, n_seen array<long>, log_score double")


def op3_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff_scores(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.col("n_seen")[0].alias("n_by_three"),
        F.col("n_seen")[1].alias("n_by_two"),
        F.col("n_seen")[2].alias("n_by_one"),
        F.round("log_score", 4).alias("log_score"),
    )


ORACLE_SQL = """
WITH texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS w, unnest(range(1, len(w) + 1)) AS i FROM texts),
grams AS (
    SELECT doc_id, i, w AS g1,
        CASE WHEN i >= 2 THEN lag(w) OVER d || ' ' || w END AS g2,
        CASE WHEN i >= 3 THEN lag(w, 2) OVER d || ' ' || lag(w) OVER d || ' ' || w END AS g3
    FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
counted AS (
    SELECT doc_id, i,
        count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS c1,
        CASE WHEN g2 IS NULL THEN 0
            ELSE count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) END AS c2,
        CASE WHEN g3 IS NULL THEN 0
            ELSE count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) END AS c3,
        greatest(count(*) OVER () - count(*) OVER (PARTITION BY doc_id), 1) AS rest
    FROM grams),
contexts AS (
    SELECT *, lag(c1) OVER d AS b1, lag(c2) OVER d AS b2, least(i, 3) AS longest
    FROM counted WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
scored AS (
    SELECT doc_id,
        CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 WHEN c1 > 0 THEN 1 ELSE 0 END AS n,
        CASE WHEN c3 > 0 THEN ln(c3 / b2)
            WHEN c2 > 0 THEN ln(c2 / b1) + (longest - 2) * ln(0.4)
            ELSE ln(greatest(c1, 1) / rest) + (longest - 1) * ln(0.4) END AS score
    FROM contexts)
SELECT t.doc_id, CAST(count(s.n) AS BIGINT) AS n_words,
    count(*) FILTER (s.n = 3) AS n_by_three, count(*) FILTER (s.n = 2) AS n_by_two,
    count(*) FILTER (s.n = 1) AS n_by_one, round(coalesce(sum(score), 0.0), 4) AS log_score
FROM texts t LEFT JOIN scored s USING (doc_id) GROUP BY t.doc_id
"""
