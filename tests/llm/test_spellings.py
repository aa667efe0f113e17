import random
import re
import zlib
from collections import Counter

import pytest

from matchlake.llm.spellings import counted_words, near_pairs, op12_spellings, spelling_forms

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, min_chars=5, min_count=3):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                counts[run] += 1
    return {word: n for word, n in counts.items() if n >= min_count}


def one_edit(word, letters):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cuts if b}
    found |= {a + c + b[1:] for a, b in cuts if b for c in letters}
    found |= {a + c + b for a, b in cuts for c in letters}
    return found - {word}


def brute_forms(counts):
    letters = sorted({c for word in counts for c in word})
    near = {word: [x for x in one_edit(word, letters) if x in counts] for word in counts}
    form = {}
    for word, found in near.items():
        best = min(found, key=lambda x: (-counts[x], x), default=None)
        form[word] = best if best and counts[best] >= 2 * counts[word] else None
    rows = {}
    for word, n in counts.items():
        root = word
        while form[root]:
            root = form[root]
        rows[word] = (form[word], root, n, len(near[word]), counts.get(form[word]))
    return rows


def as_dict(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_query_equals_brute_force(spark, sf_dir, sf_texts):
    expected = brute_forms(brute_counts(sf_texts.items()))
    assert as_dict(op12_spellings(spark, sf_dir)) == expected
    assert any(form for form, *_ in expected.values())


def test_pairs_at_one_edit_are_all_found(spark):
    draw, words = random.Random(8), set()
    for _ in range(60):
        words.add("".join(draw.choice("abé") for _ in range(draw.randint(5, 14))))
    for word in sorted(words):
        words |= {x for x in one_edit(word, "abé") if len(x) >= 5 and draw.random() < 0.3}
    words |= {"ÿ" * n for n in range(5, 40)}
    df = spark.createDataFrame([(word, len(word)) for word in sorted(words)], "word string, n long")
    rows = [(r.word, r.near, r.n_near) for r in near_pairs(df).collect()]
    letters = "abéÿ"
    expected = {(a, b, len(b)) for a in words for b in one_edit(a, letters) if b in words}
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_chains_and_ties(spark):
    counts = {"aaaaa": 4, "aaaab": 8, "aaabb": 16, "aabbb": 32, "abbbb": 64, "bbbbb": 128, "zzzzz": 5, "zzzzy": 10, "zzzzx": 10, "lonely": 1}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = as_dict(spelling_forms(df))
    assert found == brute_forms(counts)
    assert found["aaaaa"][:2] == ("aaaab", "bbbbb") and found["zzzzz"][0] == "zzzzx" and found["lonely"][:2] == (None, "lonely")


def test_odd_rows(make_docs):
    long = "Straße strasse " * 50_000
    rows = [(1, None), (2, ""), (3, "Wörter ÉCOLE école wörter,wörter wort"), (3, "Wörter ÉCOLE"), (3, "Wörter ÉCOLE"), (None, "hello " * 4), (4, long)]
    found = {r.word: r.n for r in counted_words(make_docs(rows)).collect()}
    assert found == brute_counts(rows)
    assert spelling_forms(counted_words(make_docs([]))).count() == 0


@pytest.mark.parametrize("errors", [1, 2])
def test_errors_take_one_code_point(make_docs, errors):
    rows = [(i, "wörtlich") for i in range(40)]
    found = {r.word: r.n for r in counted_words(make_docs(rows), min_chars=1, min_count=1, errors=errors).collect()}
    expected = Counter()
    for i, run in rows:
        h = zlib.crc32(f"{i}:{run}".encode())
        expected[run[: h % 8] + run[h % 8 + 1 :] if h % errors == 0 else run] += 1
    assert found == expected
