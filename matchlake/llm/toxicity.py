"""Toxicity: a word classifier that is regularised by counterfactuals.

The classifier is a logistic regression over the presence of words and of word beginnings, which
stand for the inflected and compound forms of a word. For each labelled text that mentions a group of people, a counterfactual is made by swapping its identity terms for others of
the same kind, and training penalises the square of the change in score, that of word beginnings included. So a group's name alone
cannot carry much weight, and neutral mentions are not taken for toxic ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from matchlake.llm.common import in_fold, table
from matchlake.session import materialise

WORD = re.compile(r"\w+")
BEGINNINGS = range(4, 9)
# Identity terms by kind. The first of each kind is the neutral one.
IDENTITY_TERMS = [
    ["believers", "atheists", "buddhists", "christians", "hindus", "jews", "muslims", "sikhs"],
    ["religious", "atheist", "buddhist", "christian", "hindu", "jewish", "muslim", "sikh"],
    ["foreign", "african", "american", "arab", "asian", "chinese", "european", "indian", "latino", "mexican"],
    ["people", "men", "women", "boys", "girls"],
    ["person", "man", "woman", "boy", "girl"],
    ["straight", "bisexual", "gay", "homosexual", "lesbian", "queer", "trans", "transgender"],
    ["citizens", "immigrants", "migrants", "refugees"],
    ["ordinary", "black", "brown", "white"],
    ["healthy", "blind", "deaf", "disabled"],
    ["adult", "elderly", "old", "young"],
]


@dataclass(frozen=True)
class Settings:
    """max_rows bounds the labelled rows that are learnt from, chosen by the hash of their ids;
    max_features bounds the vocabulary. A word (or beginning) is a feature if at least min_rows texts have
    it and its log-likelihood ratio against the label is at least min_ratio.
    """

    max_rows: int = 20_000
    max_features: int = 4_096
    min_rows: int = 3
    min_ratio: float = 20.0
    ridge: float = 2e-5
    counterfactual: float = 10.0
    steps: int = 1_000


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        """Between 0 and 1; a text without known words, an empty or a null one, gets the base rate."""
        known = self.weights.keys() & words_of(text)
        return float(1 / (1 + np.exp(-self.bias - sum(self.weights[word] for word in sorted(known)))))


def words_of(text: str | None) -> set[str]:
    """The different words in lower case, and their beginnings of BEGINNINGS letters, marked by a star."""
    return _with_beginnings(set(WORD.findall((text or "").lower())))


def _with_beginnings(words: set[str]) -> set[str]:
    return words | {f"{word[:n]}*" for n in BEGINNINGS for word in words if len(word) > n}


def swapped_words_of(text: str | None) -> set[str] | None:
    """`words_of` the text with its identity terms swapped, beginnings included; None for a text without such terms."""
    swaps, words = swapped_terms(), set(WORD.findall((text or "").lower()))
    gone = words & swaps.keys()
    return _with_beginnings(words - gone | {swaps[word] for word in gone}) if gone else None


_FEATURES = pa.struct([("words", pa.list_(pa.string())), ("swapped", pa.list_(pa.string()))])
# Texts whose features a worker holds as Python strings at once.
SOME_TEXTS = 64


@F.arrow_udf(StructType().add("words", ArrayType(StringType())).add("swapped", ArrayType(StringType())))
def features_of(texts: pa.Array) -> pa.Array:
    """The features of each text, and those of its counterfactual if it has one."""
    parts = []
    for at in range(0, len(texts), SOME_TEXTS):
        some = texts.slice(at, SOME_TEXTS).to_pylist()
        words = [sorted(words_of(text)) for text in some]
        swapped = [None if (of := swapped_words_of(text)) is None else sorted(of) for text in some]
        parts.append(pa.StructArray.from_arrays([pa.array(x, f.type) for x, f in zip((words, swapped), _FEATURES)], fields=list(_FEATURES)))
    return pa.concat_arrays(parts) if parts else pa.array([], _FEATURES)


def swapped_terms() -> dict[str, str]:
    """Each identity term with the one it is swapped for: the next of its kind, the first after the last."""
    return {a: b for kind in IDENTITY_TERMS for a, b in zip(kind, [*kind[1:], kind[0]])}


def _log_likelihood_ratio(pos: Column, rows: Column, all_pos: int, all_rows: int) -> Column:
    """How far the label depends on a word: twice the log ratio of the 2 x 2 table to independence."""

    def term(seen: Column, row: Column, column: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * all_rows / (row * column))).otherwise(0.0)

    negatives, others = all_rows - all_pos, F.lit(all_rows) - rows
    table_2x2 = [
        term(pos, rows, all_pos),
        term(rows - pos, rows, negatives),
        term(F.lit(all_pos) - pos, others, all_pos),
        term(F.lit(negatives) - rows + pos, others, negatives),
    ]
    return F.lit(2.0) * sum(table_2x2[1:], table_2x2[0])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Learn from the documents that `labels` (doc_id, toxic) marks.

    Labels without id or mark are ignored, an id marked twice is toxic if any mark says so, and equal
    texts count once for each mark. Spark picks the rows, takes the words apart and counts them against the label;
    what reaches the driver are at most max_features words and, for at most max_rows rows,
    which of those words they have. Without labelled rows of both kinds the model gives the
    smoothed base rate.
    """
    marked = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marked = marked.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    sample = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most max_rows rows
    texts = texts.select("text", "toxic").dropDuplicates()
    rows = texts.select("toxic", features_of("text").alias("of")).select("toxic", "of.*")
    rows = materialise(rows)
    n_rows, n_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    bias = float(np.log((n_toxic + 0.5) / (n_rows - n_toxic + 0.5)))
    if not 0 < n_toxic < n_rows:
        return Model({}, bias)
    seen = rows.select("toxic", F.explode("words").alias("word"))
    counted = seen.groupBy("word").agg(F.sum("toxic").cast("double").alias("pos"), F.count("*").cast("double").alias("n"))
    ratio = _log_likelihood_ratio(F.col("pos"), F.col("n"), n_toxic, n_rows)
    best = counted.withColumn("ratio", ratio).filter((F.col("n") >= settings.min_rows) & (F.col("ratio") >= settings.min_ratio))
    best = best.orderBy(F.desc("ratio"), "word").limit(settings.max_features)
    swaps = swapped_terms()
    vocabulary = sorted({row.word for row in best.collect()} | swaps.keys())
    listed = F.array(*map(F.lit, vocabulary))
    known = [F.array_intersect(name, listed).alias(name) for name in ("words", "swapped")]
    found = rows.select("toxic", *known).toPandas()
    weights, bias = _minimise(found["words"], found["swapped"], found["toxic"].to_numpy(float), vocabulary, bias, settings)
    return Model(dict(zip(vocabulary, weights.tolist())), bias)


def _minimise(known, swapped, toxic: np.ndarray, vocabulary: list[str], bias: float, settings: Settings):
    """Adam on the mean log loss, plus the ridge, plus the mean squared change of score under swaps, over all features."""
    number = {word: i for i, word in enumerate(vocabulary)}
    row, column = [], []  # which row has which word
    s_row, s_column, s_sign = [], [], []  # what a swap takes away and adds
    for i, (words, other) in enumerate(zip(known, swapped)):
        here = set(words)
        row += [i] * len(here)
        column += [number[word] for word in here]
        there = here if other is None else set(other)
        for sign, changed in ((-1.0, sorted(here - there)), (1.0, sorted(there - here))):
            s_row += [i] * len(changed)
            s_column += [number[word] for word in changed]
            s_sign += [sign] * len(changed)
    row, column, s_row, s_column = (np.array(x, np.int64) for x in (row, column, s_row, s_column))
    s_sign, n, size = np.array(s_sign), len(toxic), len(vocabulary)
    w, mean, square = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    w[-1] = bias
    for step in range(1, settings.steps + 1):
        margin = w[-1] + np.bincount(row, w[column], n)
        error = (1 / (1 + np.exp(-margin)) - toxic) / n
        change = np.bincount(s_row, s_sign * w[s_column], n) / n
        slope = np.append(np.bincount(column, error[row], size) + settings.ridge * w[:-1], error.sum())
        slope[:-1] += 2 * settings.counterfactual * np.bincount(s_column, s_sign * change[s_row], size)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        w -= 0.1 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8) / (1 + step / 200)
    return w[:-1], float(w[-1])


def scores(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to scores."""
    shared = spark.sparkContext.broadcast(model)  # at most max_features words

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(text) for text in texts], dtype="float64")

    return scored


def remove_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, settings: Settings = Settings()) -> DataFrame:
    """The documents, all columns as they are, that score less than the threshold."""
    scored = scores(docs.sparkSession, fit(docs, labels, settings))
    return docs.filter(scored(F.col("text")) < threshold)


def training_labels(labels: DataFrame) -> DataFrame:
    """The labels that may be learnt from: one fold of five is held out."""
    return labels.filter(~in_fold(F.col("doc_id"), 5, 0))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = scores(spark, fit(docs, training_labels(labels)))
    rows = docs.select("doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), scored(F.col("text")).alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
