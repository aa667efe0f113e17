import pytest

from matchlake.llm import licenses
from matchlake.llm.licenses import license_scan

WORDS = [f"word{i}" for i in range(300)]


@pytest.fixture(scope="module")
def templates(spark):
    sizes = [5, 6, 8, 9, 10, 13, 20, 40, 100, 200]
    rows = [(f"t{n}", " ".join(f"{w}x{n}" for w in WORDS[:n])) for n in sizes]
    return spark.createDataFrame([*rows, ("none", None), ("blank", " ."), ("tiny", "only two")], "license string, text string")


def found(docs, templates):
    return {(r.doc_id, r.license): (round(r.containment, 3), r.first_word) for r in license_scan(docs, templates).collect()}


def test_templates_are_found_at_any_place(make_docs, templates):
    texts = {r.license: r.text for r in templates.collect() if r.license[0] == "t" and r.license != "tiny"}
    rows = [(1000 * int(name[1:]) + at, "pad " * at + text.upper() + "! and more words after it", "en", "s")
            for name, text in texts.items() for at in (0, 1, 3, 7, 50)]
    hits = found(make_docs(rows), templates)
    assert set(hits) == {(1000 * int(name[1:]) + at, name) for name in texts for at in (0, 1, 3, 7, 50)}
    assert {share for share, _ in hits.values()} == {1.0}


def test_containment_is_exact(make_docs, templates):
    text = [f"{w}x100" for w in WORDS[:100]]
    cut = [" ".join(text[:n]) for n in (81, 80)]  # 77 and 76 of 96 shingles
    broken = " ".join([*text[:50], "other", *text[51:]])  # 91 of 96
    hits = found(make_docs([(1, cut[0]), (2, cut[1]), (3, broken)]), templates)
    assert {k: v[0] for k, v in hits.items()} == {(1, "t100"): 0.802, (3, "t100"): 0.948}


def test_odd_texts(make_docs, templates):
    rows = [(1, None), (2, ""), (3, "..."), (4, "only two"), (5, "only two words"), (None, "only, TWO"), (4, "only two")]
    rows += [(6, "x " * 50_000 + " ".join(f"{w}x20" for w in WORDS[:20]))]
    assert found(make_docs(rows), templates).keys() == {(4, "tiny"), (None, "tiny"), (6, "t20")}
    assert found(make_docs([]), templates) == {}
    assert found(make_docs(rows), templates.limit(0)) == {}


@pytest.mark.parametrize(("size", "cut"), [(9, 1), (10, 1), (14, 2), (24, 4)])
def test_altered_copies_at_the_limit_are_found(spark, make_docs, size, cut):
    """A copy without its last words holds just the share of shingles that is needed."""
    texts = [[f"c{n}x{i}" for i in range(size)] for n in range(40)]
    templates = spark.createDataFrame([(f"t{n}", " ".join(words)) for n, words in enumerate(texts)], "license string, text string")
    rows = [(n, " ".join(["before it", *words[: size - cut], f"and other words {n} after it"])) for n, words in enumerate(texts)]
    hits = found(make_docs(rows), templates)
    assert len({i for i, name in hits if name == f"t{i}"}) == len(hits) >= 0.99 * 40


def test_bands_make_misses_rare():
    for size in (n for n in range(1, 300) if licenses.window_class(n) == n):
        likeness = licenses.least_likeness(size)
        assert likeness == 1 or (1 - likeness) ** licenses.bands(size) <= 0.0004, size


def test_no_python_runs(make_docs, templates):
    plan = license_scan(make_docs([(1, "only two")]), templates)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
