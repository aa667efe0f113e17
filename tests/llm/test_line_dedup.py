from matchlake.llm.line_dedup import line_dedup, without_boilerplate

COMMON = "this line stands on many sites"
OWN = "only one document has this line"


def texts(df):
    return sorted((-1 if r.row.doc_id is None else r.row.doc_id, r.text, r.n_lines, r.n_removed) for r in df.collect())


def test_the_first_place_of_a_wide_line_stays(make_docs):
    docs = make_docs([(i, f"{OWN} {i}\n  {COMMON}\r\n{COMMON}", "en", f"s{i}") for i in range(4)])
    found = texts(line_dedup(docs, min_sites=3))
    assert found[0] == (0, f"{OWN} 0\n  {COMMON}\r", 3, 1)
    assert found[1:] == [(i, f"{OWN} {i}", 3, 2) for i in (1, 2, 3)]


def test_the_threshold_is_exact(make_docs):
    rows = [(i, f"{COMMON}\nand {'more ' * 5}{i}", "en", f"s{i}") for i in range(60)]
    rows += [(100 + i, f"another line on fewer sites\nx{i}", "en", f"s{i % 59}") for i in range(70)]
    found = texts(line_dedup(make_docs(rows), min_sites=60))
    assert sum(n for *_, n in found) == 59


def test_many_rows_of_few_sites_are_not_wide(make_docs):
    docs = make_docs([(i, COMMON, "en", f"s{i % 2}") for i in range(50)])
    assert all(n == 0 for *_, n in texts(line_dedup(docs, min_sites=3)))


def test_odd_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, COMMON, "en", None), (None, COMMON, "en", "s1")]
    rows += [(5, COMMON, "en", "s2"), (5, COMMON, "en", "s2"), (6, COMMON, "en", "s3"), (7, "short", "en", "s1")]
    found = texts(line_dedup(make_docs(rows), min_sites=3))
    assert found[0] == (-1, COMMON, 1, 0)  # rows without id come first
    assert found[1:] == [
        (1, None, 0, 0), (2, "", 1, 0), (3, "\n\n", 3, 0), (4, "", 1, 1), (5, "", 1, 1), (5, "", 1, 1), (6, "", 1, 1),
        (7, "short", 1, 0),
    ]


def test_very_long_texts(make_docs):
    long = "\n".join([COMMON, *(f"line number {i} of a long text" for i in range(20_000)), COMMON])
    docs = make_docs([(i, long if i == 9 else COMMON, "en", f"s{i}") for i in range(10)])
    row = next(r for r in line_dedup(docs, min_sites=10).collect() if r.row.doc_id == 9)
    assert (row.n_lines, row.n_removed) == (20_002, 2)
    assert row.text == "\n".join(long.split("\n")[1:-1])


def test_documents_and_columns_stay(make_docs):
    docs = make_docs([(i, f"{COMMON}\n{OWN} {i}" if i < 3 else COMMON, "en", f"s{i}") for i in range(5)])
    kept = without_boilerplate(docs, min_sites=3)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [
        (0, f"{COMMON}\n{OWN} 0"), (1, f"{OWN} 1"), (2, f"{OWN} 2")
    ]
    assert without_boilerplate(docs.limit(0)).count() == 0


def test_a_document_goes_only_if_no_text_is_left(make_docs):
    poem = "\n".join(f"short line {i}" for i in range(1000))
    rows = [(i, COMMON, "en", f"s{i}") for i in range(3)]
    rows += [(3, f"{poem}\n{COMMON}", "en", "s3"), (4, f" \t\n{COMMON}\n\r", "en", "s4"), (5, "", "en", "s5"), (6, None)]
    kept = {r.doc_id: r.text for r in without_boilerplate(make_docs(rows), min_sites=3).collect()}
    assert kept == {0: COMMON, 3: poem, 5: "", 6: None}


def test_no_python_runs(make_docs):
    plan = line_dedup(make_docs([(1, COMMON)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
