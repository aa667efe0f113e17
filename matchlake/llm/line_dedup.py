"""Line dedup by distinct-site spread, in DataFrame operations only.

A line that stands on many sites is boilerplate. Each different line has a HyperLogLog sketch of its
sites; sketches merge as the rows are aggregated, so a line that stands everywhere costs one row
for each task. Lines whose estimate is near the threshold are decided by an exact distinct
count. Of a boilerplate line the first place (by document id, then position) stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import table
from matchlake.session import materialise

# Relative error of a sketch of 2 ** LG_K cells is about 1.04 / sqrt(2 ** LG_K), here 3 %.
LG_K, BAND = 10, 0.2
# Keys to which the places of one line are dealt.
SALTS = 16
KEY = ["line_hash", "line_hash2"]
PLACE = ["doc_id", "version", "position"]


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _is_long(line: Column, min_words: int) -> Column:
    """Whether a trimmed line has min_words words; the match stops at the last of them."""
    return line.rlike(f"^(?:[^ \t]+[ \t]+){{{min_words - 1}}}[^ \t]")


def long_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """One row for each line of at least min_words words: its place, its site and two hashes of it."""
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("version"),
        F.col("site"),
        F.posexplode(F.split("text", "\n")).alias("position", "raw"),
    )
    kept = lines.withColumn("line", _trimmed(F.col("raw"))).filter(_is_long(F.col("line"), min_words))
    hashes = F.xxhash64("line").alias(KEY[0]), F.xxhash64(F.lit(1), "line").alias(KEY[1])
    return kept.select(*PLACE, "site", *hashes)


def boilerplate(lines: DataFrame, min_sites: int) -> DataFrame:
    """The hashes of the lines on at least min_sites sites, with their first places."""
    spread = lines.groupBy(*KEY).agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("about"),
        F.min(F.struct(*PLACE)).alias("first"),
    )
    likely = materialise(spread.filter(F.col("about") >= min_sites * (1 - BAND)))
    near = likely.filter(F.col("about") <= min_sites * (1 + BAND))
    counted = lines.join(near.select(*KEY), KEY, "left_semi").groupBy(*KEY).agg(F.count_distinct("site").alias("sites"))
    decided = counted.filter(F.col("sites") >= min_sites).select(*KEY)
    sure = likely.filter(F.col("about") > min_sites * (1 + BAND))
    return sure.unionByName(near.join(decided, KEY)).select(*KEY, "first")


def _places(lines: DataFrame, wide: DataFrame) -> DataFrame:
    """The places of wide lines but the first. The places of a line that stands everywhere are dealt to SALTS keys."""
    salt = F.pmod(F.xxhash64("doc_id", "position"), F.lit(SALTS))
    salted = wide.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    found = lines.withColumn("salt", salt).join(salted, [*KEY, "salt"])
    return found.filter(~F.struct(*PLACE).eqNullSafe(F.col("first"))).select(*PLACE)


def line_dedup(docs: DataFrame, site: str = "source", min_sites: int = 10, min_words: int = 5) -> DataFrame:
    """(row, n_lines, n_removed, n_long_left, text): each row of `docs` and its text without boilerplate lines.

    A line is what stands between line feeds, without blanks at its ends; lines of less than min_words words stay. Rows
    without site make no line wider spread. A null text stays null, has no lines and loses none. A text all
    of whose lines go becomes empty. Repeated rows of an id are treated alike, and the first
    place of a line is theirs together; rows without id come first. `row` holds all columns as
    they were, so no name can clash. Texts are split once, and the hashes of long lines stored; only these are
    shuffled for the counts. Texts move once, to meet the positions they lose.
    """
    rows = docs.select("doc_id", "text", F.col(site).cast("string").alias("site"))
    lines = materialise(long_lines(rows, min_words))
    found = _places(lines, boilerplate(lines, min_sites))
    gone = found.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set("position")).alias("gone"))
    gone = gone.select(F.col("doc_id").alias("of_id"), F.col("version").alias("of_version"), "gone")

    whole = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("version"))
    same = F.col("row.doc_id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version"))
    joined = whole.join(gone, same, "left")
    parts = F.split("row.text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("gone"))
    kept = F.transform(left, lambda i: F.get(parts, i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    n_long = F.size(F.filter(F.split("text", "\n"), lambda x: _is_long(_trimmed(x), min_words)))
    return joined.select(
        "row",
        F.when(F.col("row.text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        text.alias("text"),
    ).withColumn("n_long_left", F.when(F.col("text").isNull(), 0).otherwise(n_long).cast("long"))


def without_boilerplate(docs: DataFrame, **settings) -> DataFrame:
    """The documents with their texts cleaned; one that has lost lines and has only blank ones left goes."""
    found = line_dedup(docs, **settings).filter((F.col("n_removed") == 0) | F.col("text").rlike("[^ \\t\\r\\n]"))
    return found.select(F.col("row").withField("text", F.col("text")).alias("row")).select("row.*")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.length("text").cast("long").alias("n_chars_left"),
        F.sha2("text", 256).alias("text_sha256"),
    )


ORACLE_SQL = """
WITH split AS (
    SELECT doc_id, source, text, string_split(text, chr(10)) AS parts FROM documents),
places AS (
    SELECT doc_id, source, unnest(parts) AS raw, unnest(range(len(parts))) AS position FROM split),
trimmed AS (
    SELECT doc_id, source, position, regexp_replace(raw, '^[ \\t\\r]+|[ \\t\\r]+$', '', 'g') AS line FROM places),
lines AS (
    SELECT * FROM trimmed WHERE len(string_split_regex(line, '[ \\t]+')) >= 5),
wide AS (
    SELECT line, min((doc_id, position)) AS first FROM lines
    GROUP BY line HAVING count(DISTINCT source) >= 10),
gone AS (
    SELECT doc_id, position FROM lines JOIN wide USING (line) WHERE (doc_id, position) <> first),
kept AS (
    SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY position), '') AS text
    FROM places ANTI JOIN gone USING (doc_id, position) GROUP BY doc_id)
SELECT s.doc_id, CAST(coalesce(len(s.parts), 0) AS BIGINT) AS n_lines,
    coalesce(g.n, 0) AS n_removed,
    CAST(length(CASE WHEN s.text IS NOT NULL THEN coalesce(k.text, '') END) AS BIGINT) AS n_chars_left,
    sha256(CASE WHEN s.text IS NOT NULL THEN coalesce(k.text, '') END) AS text_sha256
FROM split s LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
    LEFT JOIN kept k USING (doc_id)
"""
