"""Spelling variants: words within one edit, joined on asymmetric q-chunks.

One word is cut into two disjoint chunks, of the other all positional grams of fitting length stand against them. One edit hits one
of the chunks only, so the other one is found in the other word, shifted by one at most. Half a word alone is shared by
thousands of others. So the chunk that is hit is cut into two again, and of these one is found as well, within the same
shift. A key is all that the edit leaves: the chunk, and the part of the other. Each word gives four of them as the
one that is cut, and as the other one the grams at the places for each of the three lengths the first may have. What meets
is verified by the whole edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import lower_ascii, table
from matchlake.session import materialise

RUNS = "[a-zÀ-ÿ]+"
MIN_CHARS, MIN_COUNT = 5, 3
# A typing error for each so many words: the run loses a code point.
ERRORS = 97


def counted_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, errors: int = ERRORS) -> DataFrame:
    """(word, n): how often each run of letters stands in the texts, once one of `errors` has lost a code point.

    Which runs lose one, and which, depends on the crc32 of id and run. Null texts have no runs; a null id counts as an
    empty one. Rows that repeat count again. Counts are added up before the shuffle, so a frequent word costs a row a task.
    """
    run = F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUNS), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    digest = F.crc32(F.concat("id", F.lit(":"), "run"))
    place = F.pmod(digest, F.length("run")).cast("int")
    shorter = F.concat(F.left("run", place), F.substring("run", place + 2, F.length("run")))
    words = runs.select(F.when(digest % errors == 0, shorter).otherwise(F.col("run")).alias("word"))
    counts = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _keys(length: Column) -> Iterator[Column]:
    """For each quarter of a word of this length: what an edit in it leaves, as a hash, read off a word of any length."""
    half = F.shiftright(length, 1)
    cuts = [F.lit(0), F.shiftright(half, 1), half, half + F.shiftright(length - half, 1), length]
    for quarter, (start, stop) in enumerate(zip(cuts, cuts[1:])):
        yield F.xxhash64(length, F.lit(quarter), F.left("word", start), F.right("word", length - stop))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, n_near) for each two of the different words in (word, n) that are one edit apart, in both directions.

    n_near is the count of `near`. Words must have at least four code points, so that no chunk is empty. The join has keys of
    three quarters of a word; the few words that share one are compared, and adaptive execution splits a key that is
    shared by many.
    """
    length = F.length("word")
    cut = words.select("word", F.explode(F.array(*_keys(length))).alias("key"))
    lengths = [length + shift for shift in (-1, 0, 1)]
    grams = F.explode(F.array(*[key for of_other in lengths for key in _keys(of_other)]))
    against = words.select(F.col("word").alias("near"), F.col("n").alias("n_near"), grams.alias("key"))
    met = cut.join(against, "key").filter(F.col("word") != F.col("near"))
    return met.filter(F.levenshtein("word", "near", 1) == 1).select("word", "near", "n_near").distinct()


def spelling_forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each of the words in (word, n).

    The form is the most frequent near word, the first in code-point order of equally frequent ones, if it is at least twice as frequent
    as the word; else null. The root is the last of the forms that follow one another, the word itself without one.
    Frequencies double on the way, so there are at most as many as n has bits; each round of the search goes twice as far.
    """
    best = F.min(F.struct((-F.col("n_near")).alias("order"), F.col("near").alias("form")))
    found = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    frequent = -F.col("best.order") >= 2 * F.col("n")
    rows = materialise(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(frequent, F.col("best.form")).alias("form"), F.when(frequent, -F.col("best.order")).alias("form_n"),
    ))
    steps = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    most = words.agg(F.max("n")).first()[0] or 1
    for _ in range(most.bit_length().bit_length()):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = materialise(steps.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
    return rows.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spelling forms of the words of all documents.

    Odd rows are as in `counted_words`; extra columns are ignored, and an empty table gives an empty result.
    """
    words = materialise(counted_words(table(spark, sf_dir, "documents")))
    return spelling_forms(words).select("word", "form", "root", "n", "n_near", "form_n")


ORACLE_SQL = """
WITH RECURSIVE
runs AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents),
counts AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
-- crc32, byte by byte, with the usual table of 256 remainders
remainders AS (
    SELECT list(r ORDER BY i) AS of_byte FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
        FROM range(256) t(i))),
bytes AS (
    SELECT doc_id, run, n, [('0x' || x)::BIGINT FOR x IN
        regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)), '..')] AS codes
    FROM counts),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, codes),
        lambda c, b: xor(c >> 8, of_byte[xor(c & 255, b) + 1]))) AS h
    FROM bytes, remainders),
typed AS (
    SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
        ELSE run END AS word, n FROM hashed),
words AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS (
    SELECT word, n, p, left(word, p - 1) || substr(word, p + 1) AS rest
    FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS p)),
pairs AS (
    SELECT a.word, b.word AS near, b.n FROM shorter a JOIN shorter b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min((-n, near)) AS first FROM pairs GROUP BY word),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN -first[1] >= 2 * w.n THEN first[2] END AS form,
        CASE WHEN -first[1] >= 2 * w.n THEN -first[1] END AS form_n
    FROM words w LEFT JOIN best USING (word)),
way AS (
    SELECT word, word AS root, form FROM formed
    UNION ALL SELECT way.word, formed.word, formed.form FROM way JOIN formed ON way.form = formed.word)
SELECT word, formed.form, root, n, n_near, form_n FROM formed JOIN way USING (word) WHERE way.form IS NULL
"""
