import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.llm import language_id
from matchlake.llm.language_id import bundle, gram_vectors, identify, learn, letter_vector, op10_language_id, trigrams


def brute_bundle(text):
    """Each word's letters with a gap before and after; all three in a row bound and added."""
    total = np.zeros(language_id.DIMENSIONS)
    letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    codes = [0] + [code for word in letters for code in [*map(ord, word), 0]]
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b:
            total += letter_vector(a) * np.roll(letter_vector(b), 1) * np.roll(letter_vector(c), 2)
    return total


@pytest.mark.parametrize("text", ["a", "The cat, the CAT!", "ß é naïve 42 x", "日本語 text"])
def test_bundles_equal_brute_force(text):
    grams = np.unique(trigrams(text), return_counts=True)
    assert np.array_equal(bundle([grams])[0], brute_bundle(text))


def test_blocks_do_not_change_bundles(monkeypatch):
    counts = [np.unique(trigrams(text), return_counts=True) for text in ("some words here", "", "other words")]
    whole = bundle(counts)
    monkeypatch.setattr(language_id, "GRAMS", 3)
    assert np.array_equal(bundle(counts), whole)
    assert not whole[1].any()


def test_different_grams_are_nearly_orthogonal():
    vectors = gram_vectors(np.unique(trigrams("hyperdimensional profiles of letters")))
    cosines = vectors @ vectors.T / language_id.DIMENSIONS - np.eye(len(vectors))
    assert np.abs(cosines).max() < 0.2


TRAIN = [
    (1, "the cat and the dog are in the house", "en"), (2, "der hund und die katze sind im haus", "de"), (3, None, "fr"),
    (4, "le chat", None), (5, "123", "xx"), (1, "the cat and the dog are in the house", "en"),
]


def test_odd_texts(spark, make_docs):
    profiles = learn(make_docs([(i, text, lang, "s") for i, text, lang in TRAIN]))
    assert sorted(profiles) == ["de", "en"]
    texts = [(1, "the house"), (2, "Und der Hund"), (3, None), (4, ""), (5, "12 !?"), (6, "the dog " * 50_000), (None, "die katze")]
    docs = make_docs([*texts, (1, "the house")])
    rows = docs.select("doc_id", identify(spark, profiles)(F.col("text")).alias("x")).collect()
    assert sorted(((r.doc_id or 0), r.x.lang_pred) for r in rows) == [
        (0, "de"), (1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en")
    ]
    assert all(0 <= r.x.score <= 1 for r in rows)
    assert all(r.x.score == 0 for r in rows if r.x.lang_pred == "und")


def test_nothing_learnt(spark, make_docs):
    assert learn(make_docs([])) == {}
    docs = make_docs([(1, "text"), (2, None)])
    rows = docs.select(identify(spark, {})(F.col("text")).alias("x")).collect()
    assert [tuple(r.x) for r in rows] == [("und", 0.0)] * 2


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op10_language_id(spark, sf_dir).filter("held_out").join(docs, "doc_id").collect()
    assert len(rows) > 200
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
