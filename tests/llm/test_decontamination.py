import pytest
from pyspark.sql import functions as F

from matchlake.llm.decontamination import contamination, decontaminate, window_blocks, with_contamination

LONG = " ".join(f"w{i}" for i in range(20))


@pytest.fixture
def benchmark(spark):
    rows = [(1, LONG), (1, LONG), (2, "Short item!"), (3, "..."), (4, None), (None, "no id here"), (12, LONG)]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(docs, benchmark, **settings):
    scanned = contamination(docs.sparkSession, benchmark, **settings)
    return {r.doc_id: r.c for r in docs.select("doc_id", scanned(F.col("text")).alias("c")).collect()}


def test_hits_are_counted_and_placed(make_docs, benchmark):
    text = "Intro: a SHORT, item... " + LONG.upper() + " end w1 w2"
    docs = make_docs([(1, text), (2, None), (3, ""), (4, "?! ..."), (5, "short items"), (6, "no-id, HERE")])
    rows = found(docs, benchmark)
    assert (rows[1].n_words, rows[1].n_hit, rows[1]["items"]) == (27, 22, ["1", "12", "2"])
    assert [text[s.start : s.end] for s in rows[1].spans] == ["SHORT, item... " + LONG.upper()]
    for i in (2, 3, 4):
        assert (rows[i].n_words, rows[i].n_hit, rows[i]["items"], rows[i].contaminated) == (0, 0, [], False)
    assert rows[5].n_hit == 0
    assert (rows[6].n_hit, rows[6]["items"], rows[6].contaminated) == (3, [], True)


def test_a_window_needs_all_its_words(make_docs, benchmark):
    twelve, thirteen = " ".join(LONG.split()[:12]), " ".join(LONG.split()[7:])
    rows = found(make_docs([(1, twelve), (2, f"x {thirteen} y {thirteen}"), (3, thirteen.replace("w9", "x9"))]), benchmark)
    assert [rows[i].n_hit for i in (1, 2, 3)] == [0, 26, 0]


def test_a_twentieth_of_the_words_is_contaminated(make_docs, benchmark):
    rows = found(make_docs([(1, "short item" + " x" * 38), (2, "short item" + " x" * 39)]), benchmark)
    assert (rows[1].contaminated, rows[2].contaminated) == (True, False)


def test_very_long_texts_are_read_to_the_end(make_docs, benchmark):
    rows = found(make_docs([(1, "x " * 300_000 + "short item")]), benchmark)
    assert (rows[1].n_words, rows[1].n_hit) == (300_002, 2)
    assert rows[1].spans[0].end == 600_010


def test_rows_and_columns_stay(make_docs, benchmark):
    docs = make_docs([(1, "clean"), (1, "clean"), (None, None), (2, "short item")])
    kept = decontaminate(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1]


def test_empty_tables(make_docs, benchmark):
    assert found(make_docs([]), benchmark) == {}
    rows = found(make_docs([(1, "short item")]), benchmark.limit(0))
    assert (rows[1].n_words, rows[1].n_hit) == (2, 0)


def test_a_benchmark_beyond_the_bound_is_refused(make_docs, benchmark):
    with pytest.raises(ValueError, match="pattern characters"):
        contamination(benchmark.sparkSession, benchmark, max_pattern_chars=100)


@pytest.mark.parametrize("bound", [1, 100, 200])
def test_a_benchmark_beyond_the_bound_is_scanned_for_in_blocks(make_docs, benchmark, bound):
    """All windows, hits, items and spans are those of one automaton; nothing is refused."""
    assert len(list(window_blocks(benchmark, 13, bound))) > 1
    text = "Intro: a SHORT, item... " + LONG.upper() + " end w1 w2"
    rows = [(1, text), (2, None), (3, ""), (4, "?!"), (5, "no id here"), (6, f"x {LONG} y {LONG}"), (None, "short item"), (7, "x")]
    rows += [(1, text), (1, LONG), (8, "short item" + " x" * 39)]
    docs = make_docs(rows)
    whole = docs.select("doc_id", "text", contamination(docs.sparkSession, benchmark)(F.col("text")).alias("found"))
    parts = with_contamination(docs, benchmark, max_pattern_chars=bound).select("row.doc_id", "row.text", "found")
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    kept = decontaminate(docs, benchmark, max_pattern_chars=bound)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, decontaminate(docs, benchmark).collect()))


def test_benchmarks_of_the_same_text_keep_their_own_items(spark, make_docs):
    docs = make_docs([(1, "some words of a test text")])
    for item in ("7", "8", "9"):
        benchmark = spark.createDataFrame([(item, "words of a test")], "item_id string, text string")
        assert [r.found["items"] for r in with_contamination(docs, benchmark).collect()] == [[item]]
