"""License scans: MinHash bands over overlapping text windows, then exact containment.

Texts and license templates are cut into shingles of five words. Templates are classed by their
number of shingles; for each class a text is cut into windows that overlap so far that some window holds a whole
template. Windows and templates are compared by MinHash values, one to a band: a window that shares
one with a template is a candidate, and the template is found in it if the window holds at
least `containment` of the template's shingles.

With BANDS bands a window whose shingles are like the template's to the degree J (Jaccard) is missed with
probability (1 - J) ** BANDS. `least_likeness` gives the J that an occurrence at the containment has at
least: 1 for templates of up to four shingles, where a single band is enough to find all, and 0.39 in
the worst class, which is missed once in 2,500 at the very edge.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import lower_ascii, table

SHINGLE, BANDS, CONTAINMENT = 5, 16, 0.8
MAX_TEMPLATES = 10_000

# Notices as their licenses or publishers give them.
TEMPLATES = {
    "Apache-2.0 (name)": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 (notice)": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "CC-BY-NC-4.0 (name)": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0 (name)": "This work is licensed under the GNU General Public License, version 3.",
    "MIT (name)": "Released under the MIT License.",
    "MIT (permission)": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
}


def window_class(n_shingles: int) -> int:
    """The class of a template: its size up to four shingles, then the next of sizes that grow by a quarter."""
    size = 1
    while size < n_shingles:
        size = max(size + 1, size * 5 // 4)
    return size


def stride(size: int) -> int:
    return max(1, size // 4)


def window_length(size: int) -> int:
    """Shingles of a window, in whole strides: a template of the class at any place lies in one."""
    return -(-(size + stride(size) - 1) // stride(size)) * stride(size)


def needed(n_shingles: int, containment: float = CONTAINMENT) -> int:
    """Shingles of a template that a window must hold."""
    return math.ceil(n_shingles * containment - 1e-9)


def bands(size: int) -> int:
    """One band for the classes in which a window must hold the whole template, else BANDS."""
    return 1 if needed(size) == size else BANDS


def least_likeness(size: int, containment: float = CONTAINMENT) -> float:
    """The least Jaccard likeness of a window with an occurrence of the smallest template of a class."""
    n = next(n for n in range(1, size + 1) if window_class(n) == size)
    held = needed(n, containment)
    return held / (window_length(size) + n - held)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def shingles(text: Column) -> Column:
    """Hashes of the shingles in order; of fewer words one hash of all, of none an empty array."""
    words = F.split(F.coalesce(lower_ascii(text), F.lit("")), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")

    def of(words: Column) -> Column:
        last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
        numbers = F.slice(F.sequence(F.lit(0), last), 1, F.when(F.size(words) > 0, last + 1).otherwise(0))
        return F.transform(numbers, lambda i: F.xxhash64(*[F.get(words, i + n) for n in range(SHINGLE)]))

    return let(F.array_remove(words, ""), of)


def least_of(values: Column, band: int) -> Column:
    """A MinHash value: the shingle whose hash under the band's own seed is least."""
    hashed = F.transform(values, lambda x: F.struct(F.xxhash64(F.lit(band), x).alias("order"), x.alias("shingle")))
    return F.array_min(hashed)["shingle"]


def template_table(templates: DataFrame) -> DataFrame:
    """(license, of_template): the different shingles of each template (license, text) that has words."""
    rows = templates.select("license", F.array_distinct(shingles(F.col("text"))).alias("of_template"))
    return rows.filter(F.size("of_template") > 0)


def _candidates(hashes: Column, places: Column, size: int, values: list[set[int]]) -> Column:
    """(class, start, held) of the windows that share the value of some band with a template of the class.

    `places` are those of the shingles in which some template's value is attained. A window can only
    have a template's value if it holds that shingle, so all other windows need not be looked at.
    """
    step, length = stride(size), window_length(size)
    of_class = sorted({value for wanted in values for value in wanted})

    def around(place: Column) -> Column:
        first = F.greatest(F.floor((place - length) / step).cast("int") + 1, F.lit(0))
        return F.sequence(first, F.floor(place / step).cast("int"))

    def shares(window: Column) -> Column:
        held = F.slice(hashes, window * step + 1, length)
        return reduce(lambda x, y: x | y, [least_of(held, n).isin(sorted(wanted)) for n, wanted in enumerate(values)])

    def described(window: Column) -> Column:
        held = F.slice(hashes, window * step + 1, length)
        return F.struct(F.lit(size).alias("class"), (window * step).alias("start"), held.alias("held"))

    near = F.filter(places, lambda place: F.get(hashes, place).isin(of_class))
    windows = F.array_distinct(F.flatten(F.transform(near, around)))
    return F.transform(F.filter(windows, shares), described)


def license_scan(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, version, license, containment, first_word): what was found, once for each text and license.

    `version` is a hash of the text; rows with the same id and text are one. containment is the best
    of the windows, and first_word the number of the word (from 0) at which the first such window
    starts. Null and empty texts, and templates without words, give nothing; several templates of one
    name count as one license. Rows without id are scanned too. `templates` (license, text) does not
    grow with the documents; the driver reads the band values of at most MAX_TEMPLATES of them to
    build the expressions, and raises ValueError if there are more.
    """
    spark = docs.sparkSession
    known = template_table(templates).limit(MAX_TEMPLATES + 1).collect()
    if len(known) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates: scan for them in parts")
    schema = "license string, of_template array<long>, class int, n int"
    rows = [(t.license, t.of_template, window_class(len(t.of_template)), len(t.of_template)) for t in known]
    table_ = spark.createDataFrame(rows, schema)
    values = F.array(*[least_of(F.col("of_template"), band) for band in range(BANDS)])
    table_ = table_.select("*", F.posexplode(values).alias("band", "value"))
    wanted: dict[int, list[set[int]]] = {}
    for row in table_.select("class", "band", "value").collect():
        of_class = wanted.setdefault(row["class"], [set() for _ in range(bands(row["class"]))])
        if row.band < len(of_class):
            of_class[row.band].add(row.value)
    none = F.array().cast("array<struct<class:int,start:int,held:array<bigint>>>")
    attained = sorted({value for values in wanted.values() for of_band in values for value in of_band})

    def candidates(hashes: Column) -> Column:
        numbers = F.slice(F.sequence(F.lit(0), F.size(hashes)), 1, F.size(hashes))
        places = F.filter(numbers, lambda i: F.get(hashes, i).isin(attained))
        return let(
            places,
            lambda places: F.concat(none, *[_candidates(hashes, places, size, wanted[size]) for size in sorted(wanted)]),
        )

    found = let(shingles(F.col("text")), candidates)
    found = docs.select("doc_id", F.xxhash64("text").alias("version"), F.explode(found).alias("at"))
    found = found.select("doc_id", "version", "at.*")
    values = F.array(*[least_of(F.col("held"), band) for band in range(BANDS)])
    keyed = found.select("*", F.posexplode(values).alias("band", "value"))
    # At most MAX_TEMPLATES * BANDS rows are sent to all tasks.
    matched = keyed.join(F.broadcast(table_), ["class", "band", "value"])
    share = F.size(F.array_intersect("held", "of_template")) / F.col("n")
    matched = matched.withColumn("share", share).filter(F.col("share") >= containment)
    return matched.groupBy("doc_id", "version", "license").agg(
        F.max("share").alias("containment"), F.min("start").alias("first_word")
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document, with the names of its licenses in order."""
    docs = table(spark, sf_dir, "documents")
    templates = spark.createDataFrame(sorted(TEMPLATES.items()), "license string, text string")
    found = license_scan(docs, templates).groupBy("doc_id", "version").agg(
        F.array_join(F.array_sort(F.collect_set("license")), "; ").alias("licenses"),
        F.count("*").alias("n_licenses"),
        F.max("containment").alias("containment"),
    )
    found = found.withColumnsRenamed({"doc_id": "of_id", "version": "of_version"})
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version"))
    return rows.join(found, same, "left").select(
        "doc_id",
        F.coalesce("n_licenses", F.lit(0)).alias("n_licenses"),
        F.coalesce("licenses", F.lit("")).alias("licenses"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"),
    )


def _oracle_sql() -> str:
    """Containment of the templates in the text's windows, found by joining all shingles."""
    quoted = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in item)) for item in sorted(TEMPLATES.items()))
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+'"
    sizes = ", ".join(f"({n}, {stride(window_class(n))}, {window_length(window_class(n))})" for n in range(1, 400))
    return f"""
WITH t AS (
    SELECT license, regexp_extract_all(translate(text, {letters}) AS w FROM (VALUES {quoted}) v(license, text)),
windows(n, step, length) AS (VALUES {sizes}),
t_rows AS (
    SELECT DISTINCT license, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT license, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t)),
t_sizes AS (
    SELECT license, n, step, length
    FROM (SELECT license, count(*) AS n FROM t_rows GROUP BY license) JOIN windows USING (n)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {letters}) AS w FROM documents),
places AS (
    SELECT doc_id, i - 1 AS i, array_to_string(w[i : i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
hits AS (
    SELECT doc_id, license, i, s, n, step, length FROM places JOIN t_rows USING (s) JOIN t_sizes USING (license)),
spread AS (
    SELECT doc_id, license, s, n, unnest(range(greatest(0, (i - length) // step + 1), i // step + 1)) AS b
    FROM hits),
held AS (
    SELECT doc_id, license, b, count(DISTINCT s) / any_value(n) AS share FROM spread GROUP BY doc_id, license, b),
found AS (
    SELECT doc_id, license, max(share) AS share FROM held WHERE share >= 0.8 GROUP BY doc_id, license)
SELECT d.doc_id, count(license) AS n_licenses,
    coalesce(string_agg(license, '; ' ORDER BY license), '') AS licenses,
    coalesce(max(share), 0.0) AS containment
FROM d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id
"""


ORACLE_SQL = _oracle_sql()
