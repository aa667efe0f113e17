"""Benchmark decontamination: one Aho-Corasick automaton over normalised test texts.

Test texts are cut into windows of `window` words (a shorter text is one window). All windows form
one automaton, which reads each document once; every occurrence marks the words it covers, and
the marked runs are given as offsets into the original text.

A benchmark whose windows exceed the bound of one automaton is cut into blocks of windows, which are scanned for one after
another; each scan reads all documents, and what the scans find is merged by document.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain

import ahocorasick
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import table
from matchlake.session import materialise

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RESULT = (
    "n_words long, n_hit long, items array<string>, contaminated boolean, "
    "spans array<struct<start:int,end:int>>"
)
NAMES = ["n_words", "n_hit", "items", "contaminated", "spans"]
# The automaton is built in every Python worker, at some 60 bytes for each pattern character.
MAX_PATTERN_CHARS = 8_000_000
_automata: dict[int, ahocorasick.Automaton] = {}


def lowered(text: str) -> str:
    """A-Z in lower case; the length stays, so offsets hold for the original too."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def each_window(text: str, window: int) -> Iterator[str]:
    words = WORD.findall(lowered(text))
    for i in range(max(len(words) - window, 0) + 1 if words else 0):
        yield f" {' '.join(words[i : i + window])} "


def windows(text: str, window: int) -> set[str]:
    return set(each_window(text, window))


def window_items(benchmark: DataFrame, window: int, max_pattern_chars: int) -> dict[str, list[str]]:
    """Which items have which window. Raises ValueError if the test texts exceed the bound.

    The size is checked before anything is collected: a text of c characters has windows of at
    most (window + 1) * (c + 2) characters in all.
    """
    size = benchmark.agg(F.sum((F.length("text") + 2) * (window + 1))).first()[0] or 0
    if size > max_pattern_chars * window:
        raise ValueError(f"test texts may need {size} pattern characters: split them, or raise the bound")
    found: dict[str, set[str]] = defaultdict(set)
    rows = benchmark.select(F.col("item_id").cast("string"), "text").filter("text IS NOT NULL")
    for item_id, text in rows.toLocalIterator():
        for pattern in windows(text, window):
            found[pattern].update([] if item_id is None else [item_id])
    if (size := sum(map(len, found))) > max_pattern_chars:
        raise ValueError(f"{size} pattern characters: split the test texts, or raise the bound")
    return {pattern: sorted(items) for pattern, items in found.items()}


def window_blocks(benchmark: DataFrame, window: int, max_pattern_chars: int) -> Iterator[dict[str, list[str]]]:
    """All windows with their items, in blocks of at most max_pattern_chars characters, or of one window.

    A window whose items do not come together may stand in several blocks, with some of the items in each.
    """
    found: dict[str, set[str]] = {}
    size = 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").filter("text IS NOT NULL")
    for item_id, text in rows.toLocalIterator():
        for pattern in each_window(text, window):
            if pattern not in found:
                if found and size + len(pattern) > max_pattern_chars:
                    yield {known: sorted(items) for known, items in found.items()}
                    found, size = {}, 0
                found[pattern] = set()
                size += len(pattern)
            found[pattern].update([] if item_id is None else [item_id])
    if found:
        yield {known: sorted(items) for known, items in found.items()}


def build(patterns: dict[str, list[str]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for pattern, items in patterns.items():
        automaton.add_word(pattern, (pattern.count(" ") - 1, items))
    if patterns:
        automaton.make_automaton()
    return automaton


def hit_runs(automaton: ahocorasick.Automaton, words: list[str]) -> tuple[list[list[int]], set[str]]:
    """The runs of hit words (numbers from and to, in order, not overlapping), and the items."""
    items: set[str] = set()
    runs: list[list[int]] = []
    ends = None
    for end, (n_words, of_items) in automaton.iter(f" {' '.join(words)} ") if words and len(automaton) else ():
        ends = ends or list(accumulate(len(word) + 1 for word in words))
        last = bisect_left(ends, end) + 1
        first = last - n_words
        while runs and runs[-1][1] >= first:
            first = min(first, runs.pop()[0])
        runs.append([first, last])
        items.update(of_items)
    return runs, items


def joined(runs: Iterable[list[int]]) -> list[list[int]]:
    """Runs of any order, in order; those that overlap or touch as one."""
    found: list[list[int]] = []
    for first, last in sorted(map(list, runs)):
        if found and found[-1][1] >= first:
            found[-1][1] = max(found[-1][1], last)
        else:
            found.append([first, last])
    return found


def described(text: str | None, runs: list[list[int]], items: Iterable[str], share: int) -> tuple:
    """Words, hit words, items, the verdict, and the hit runs as offsets of the original text."""
    places = [m.span() for m in WORD.finditer(lowered(text or ""))]
    n_hit = sum(last - first for first, last in runs)
    spans = [{"start": places[first][0], "end": places[last - 1][1]} for first, last in runs]
    return len(places), n_hit, sorted(items), n_hit > 0 and share * n_hit >= len(places), spans


def scan(automaton: ahocorasick.Automaton, text: str | None, share: int) -> tuple:
    words = WORD.findall(lowered(text or ""))
    if not words or not len(automaton):
        return len(words), 0, [], False, []
    runs, items = hit_runs(automaton, words)
    return described(text, runs, items, share) if runs else (len(words), 0, [], False, [])


def automaton_of(patterns: Broadcast) -> ahocorasick.Automaton:
    """The automaton of a broadcast block; the worker keeps the last one. The key covers windows and items."""
    key = hash(frozenset((window, *items) for window, items in patterns.value.items()))
    if key not in _automata:
        _automata.clear()
        _automata[key] = build(patterns.value)
    return _automata[key]


def contamination(spark: SparkSession, benchmark: DataFrame, window: int = 13, share: int = 20,
                  max_pattern_chars: int = MAX_PATTERN_CHARS) -> Callable[[Column], Column]:
    """A function from a text column to a struct column of `RESULT`.

    `items` are the ids (as text, sorted) of the items of which a window occurs; `contaminated`
    holds if at least 1/share of the words are hit. A null or empty text, or one without words,
    has no words, no hits and is not contaminated. Test texts without words match nothing; a test
    text without id marks words but is not listed; repeated test rows count once. An empty
    benchmark hits nothing. The automaton is the only thing sent to all tasks; its size is
    checked against `max_pattern_chars` first.
    """
    return _scanned(spark.sparkContext.broadcast(window_items(benchmark, window, max_pattern_chars)), share)


def _scanned(patterns: Broadcast, share: int) -> Callable[[Column], Column]:
    @F.pandas_udf(RESULT)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = automaton_of(patterns)
        for texts in batches:
            yield pd.DataFrame([scan(automaton, text, share) for text in texts], columns=NAMES)

    return scanned


def _hits(patterns: Broadcast) -> Callable[[Column], Column]:
    @F.pandas_udf("runs array<array<int>>, items array<string>")
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = automaton_of(patterns)
        for texts in batches:
            rows = (hit_runs(automaton, WORD.findall(lowered(text or ""))) for text in texts)
            yield pd.DataFrame([(runs, sorted(items)) for runs, items in rows], columns=["runs", "items"])

    return hits


def _merged(share: int) -> Callable[..., Column]:
    @F.pandas_udf(RESULT)
    def merged(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, runs, items in batches:
            rows = [
                described(text, joined([] if of_runs is None else of_runs), [] if of_items is None else of_items, share)
                for text, of_runs, of_items in zip(texts, runs, items)
            ]
            yield pd.DataFrame(rows, columns=NAMES)

    return merged


def with_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20,
                       max_pattern_chars: int = MAX_PATTERN_CHARS) -> DataFrame:
    """(row, found): each row of `docs`, all columns as they are, and its `RESULT` as of `contamination`.

    A benchmark of any size is scanned for: one block of windows is a scan in place; of several, each is a scan of all
    documents, and only ids, hit runs and items of the hit documents are shuffled before they meet the texts.
    """
    spark = docs.sparkSession
    blocks = window_blocks(benchmark, window, max_pattern_chars)
    first, second = next(blocks, {}), next(blocks, None)
    if second is None:
        found = _scanned(spark.sparkContext.broadcast(first), share)
        return docs.select(F.struct("*").alias("row"), found(F.col("text")).alias("found"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    hits = None
    for windows in chain([first, second], blocks):
        # A text is scanned once for a block, and the blocks one after another; the driver holds two of them at most.
        block = spark.sparkContext.broadcast(windows)
        of_block = keyed.select("doc_id", "version", _hits(block)(F.col("text")).alias("hit")).filter("size(hit.runs) > 0")
        of_block = materialise(of_block.select("doc_id", "version", "hit.*"))
        block.destroy()
        hits = of_block if hits is None else hits.unionByName(of_block)
    merged = hits.groupBy(F.col("doc_id").alias("of_id"), F.col("version").alias("of_version")).agg(
        F.array_distinct(F.flatten(F.collect_set("runs"))).alias("runs"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )
    whole = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("version"))
    same = F.col("row.doc_id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version"))
    return whole.join(merged, same, "left").select(
        "row", _merged(share)(F.col("row.text"), F.col("runs"), F.col("items")).alias("found")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """The documents, all columns as they are, without the contaminated ones."""
    return with_contamination(docs, benchmark, **settings).filter("NOT found.contaminated").select("row.*")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_contamination(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("row.doc_id").alias("doc_id"),
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        "found.contaminated",
    )


ORACLE_SQL = """
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM benchmark),
starts AS (
    SELECT item_id, w, least(len(w), 13) AS k, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i
    FROM b WHERE len(w) > 0),
patterns AS (SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS p FROM starts),
places AS (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM d, (SELECT DISTINCT k FROM patterns) WHERE len(w) >= k),
hits AS (
    SELECT doc_id, i, k, item_id
    FROM (SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS p FROM places)
    JOIN patterns USING (k, p)),
hit_words AS (
    SELECT doc_id, count(DISTINCT j) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT doc_id, i, k FROM hits))
    GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
