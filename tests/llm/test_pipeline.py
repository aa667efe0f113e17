import re
from functools import reduce

import pytest
import sentencepiece

import corpus_pipeline
from corpus_pipeline import STAGES, run
from matchlake.llm import pieces
from matchlake.llm.toxicity import fit, training_labels


def stored(df, path):
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory, sf_dir):
    """What goes into each stage and what comes out of the last."""
    folder, docs = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [docs]
    for name, stage in STAGES:
        found.append(stored(stage(spark, found[-1], sf_dir), folder / name.replace(" ", "-")))
    return found


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_return_documents(results):
    assert all(df.dtypes == results[0].dtypes for df in results[:-1])
    assert set(results[0].columns) < set(results[-1].columns)


def test_toxic_documents_go(spark, sf_dir, results):
    model = fit(results[0], training_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    kept = {r.doc_id for r in results[0].collect() if model.score(r.text) < 0.5}
    assert rows_of(results[1]).keys() == kept


def test_wide_lines_go(results):
    docs = sorted(results[1].collect())
    places = {}
    for doc in docs:
        for n, line in enumerate(doc.text.split("\n")):
            if len(line.split()) >= 5:
                places.setdefault(line.strip(" \t\r"), []).append((doc.doc_id, n, doc.source))
    gone = {p[:2] for found in places.values() if len({p[2] for p in found}) >= 10 for p in sorted(found)[1:]}
    expected = {}
    for doc in docs:
        left = [line for n, line in enumerate(doc.text.split("\n")) if (doc.doc_id, n) not in gone]
        if len(left) == doc.text.count("\n") + 1 or any(line.strip(" \t\r") for line in left):
            expected[doc.doc_id] = "\n".join(left)
    assert {i: r.text for i, r in rows_of(results[2]).items()} == expected


def test_one_of_each_group_stays(results):
    """Against all pairs: the components of the links at 0.8, of which the smallest id stays."""
    sets = {}
    for doc in results[2].collect():
        words = doc.text.lower().split()
        sets[doc.doc_id] = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and 10 * len(x & y) >= 8 * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert rows_of(results[3]).keys() == {find(i) for i in ids}


def test_contaminated_documents_go(spark, sf_dir, results):
    """Every window of every document looked up by its words."""

    def words_of(text):
        small = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", small)

    windows = set()
    for item in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = words_of(item.text)
        windows |= {tuple(words[i : i + 13]) for i in range(max(len(words) - 12, 1))} if words else set()
    sizes, kept = {len(w) for w in windows}, set()
    for doc in results[3].collect():
        words, hit = words_of(doc.text), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
        if not (hit and 20 * len(hit) >= len(words)):
            kept.add(doc.doc_id)
    assert rows_of(results[4]).keys() == kept


def test_texts_are_encoded(results):
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    for row in results[5].collect():
        assert row.ids == library.encode(row.text or "")
        assert row.decoded == row.text and row.n_tokens == len(row.ids)


def test_run_gives_the_last_stage(spark, sf_dir, results):
    found, expected = rows_of(run(spark, sf_dir)), rows_of(results[-1])
    assert {i: r.ids for i, r in found.items()} == {i: r.ids for i, r in expected.items()}


def test_odd_rows_go_through_all_stages(spark, sf_dir, make_docs, tmp_path):
    rows = [(1, None, None, None), (None, "a text without id is one of the corpus"), (2, ""), (2, ""), (3, "x " * 100_000)]
    docs = make_docs(rows)
    for n, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), tmp_path / str(n))
    assert sorted((r.doc_id or 0) for r in docs.collect()) == [0, 1, 3]
    assert {"version", "row", "key"} <= set(docs.columns)


def test_an_empty_table_goes_through_all_stages(spark, sf_dir, results):
    empty = reduce(lambda docs, stage: stage[1](spark, docs, sf_dir), STAGES, results[0].limit(0))
    assert empty.count() == 0
    assert corpus_pipeline.ORACLE_SQL is None
