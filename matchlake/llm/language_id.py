"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram is bound from its letters' vectors: they are
permuted by their place (rotated) and multiplied. A text is the bundle (the sum) of its n-grams,
a language the bundle of its texts, and a text has the language of the nearest bundle by cosine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import in_fold, table

DIMENSIONS, SEED = 1024, 7
# Documents bundled at once, and n-grams whose vectors are held at once.
DOCS, GRAMS = 256, 4096
_BITS = 21  # of a code point
_letters: dict[int, np.ndarray] = {}
_is_letter: list[np.ndarray] = []


def letter_vector(code: int) -> np.ndarray:
    """The vector of a code point; 0 stands for whatever is between words."""
    if code not in _letters:
        signs = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, DIMENSIONS)
        _letters[code] = (2 * signs - 1).astype(np.int8)
    return _letters[code]


def trigrams(text: str | None) -> np.ndarray:
    """Codes of all three-letter sequences of the words in lower case, a gap before and after each word."""
    if not _is_letter:
        _is_letter.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    raw = (text or "").lower().encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, "<u4").astype(np.int64)
    codes = np.concatenate([[0], np.where(_is_letter[0][codes], codes, 0), [0]])
    codes = codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]
    grams = codes[:-2] | codes[1:-1] << _BITS | codes[2:] << 2 * _BITS
    return grams[codes[1:-1] != 0]


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """A row for each n-gram: its letters' vectors, rotated by their places and multiplied."""
    bound = np.ones((len(grams), DIMENSIONS), np.int8)
    for place in range(3):
        codes, where = np.unique(grams >> place * _BITS & (1 << _BITS) - 1, return_inverse=True)
        letters = np.stack([np.roll(letter_vector(int(code)), place) for code in codes])
        bound *= letters[where]
    return bound.astype(np.float32)


def bundle(counts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The bundle of each (n-grams, counts), with no more than GRAMS vectors in memory."""
    out = np.zeros((len(counts), DIMENSIONS), np.float64)
    every = np.unique(np.concatenate([grams for grams, _ in counts]))
    places = [np.searchsorted(every, grams) for grams, _ in counts]
    for at in range(0, len(every), GRAMS):
        dense = np.zeros((len(counts), min(GRAMS, len(every) - at)), np.float32)
        for row, where, (_, n) in zip(dense, places, counts):
            a, b = np.searchsorted(where, [at, at + GRAMS])
            row[where[a:b] - at] = n[a:b]
        out += dense @ gram_vectors(every[at : at + GRAMS])
    return out


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all documents, counted in each task before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                grams = np.concatenate([trigrams(text) for text in texts])
                grams, n = np.unique(grams, return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    partial = docs.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """A bundle of unit length for each language of (lang, text).

    Rows without lang or text teach nothing. The driver gets one vector for each language.
    """

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, rows in batch.sort_values("gram").groupby("lang"):
                vector = bundle([(rows["gram"].to_numpy(), rows["n"].to_numpy())])[0]
                yield pd.DataFrame({"lang": lang, "place": np.arange(DIMENSIONS), "value": vector})

    counted = gram_counts(docs.filter("lang IS NOT NULL AND text IS NOT NULL"))
    parts = counted.mapInPandas(part, "lang string, place int, value double")
    summed = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    rows = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).collect()
    vectors = {row.lang: np.array([x.value for x in row.v]) for row in rows}
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(vectors.items()) if v.any()}


def nearest(texts: pd.Series, langs: list[str], profiles: np.ndarray) -> pd.DataFrame:
    answers = []
    for at in range(0, len(texts), DOCS):
        counts = [np.unique(trigrams(text), return_counts=True) for text in texts[at : at + DOCS]]
        bundles = bundle(counts)
        lengths = np.linalg.norm(bundles, axis=1)
        cosines = bundles @ profiles.T / np.maximum(lengths, 1e-9)[:, None]
        best = cosines.argmax(axis=1)
        for (grams, _), i, row in zip(counts, best, cosines):
            answers.append((langs[i], float(np.clip(row[i], 0, 1))) if len(grams) else ("und", 0.0))
    return pd.DataFrame(answers, columns=["lang_pred", "score"])


def identify(spark: SparkSession, profiles: dict[str, np.ndarray]) -> Callable[[Column], Column]:
    """A function from a text column to a struct (lang_pred, score).

    score is the cosine, at least 0. A null text or one without a letter is `und` with score 0, and so is
    every text if no language was learnt. Of languages equally near the first by name is taken.
    """
    langs = sorted(profiles)
    shared = spark.sparkContext.broadcast(np.stack([profiles[x] for x in langs]) if langs else None)

    @F.pandas_udf("lang_pred string, score double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            if langs:
                yield nearest(texts, langs, shared.value)
            else:
                yield pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts)})

    return identified


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    found = identify(spark, learn(docs.filter(~held_out)))
    rows = docs.select("doc_id", held_out.alias("held_out"), found(F.col("text")).alias("found"))
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")
