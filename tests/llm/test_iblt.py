import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm import iblt
from matchlake.llm.iblt import difference, digests, fingerprint_rows, from_text, likeness, op6_fingerprints, peel, sketch


def brute(rows):
    """Expected columns for (doc_id, text) in order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        own, new, nxt = (set(digests(x).tolist()) for x in (text, edited, following))
        near = [len(own & x) / len(own | x) if own | x else 1.0 for x in (new, nxt)]
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return out


def plain(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in df.collect()]


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.sets(st.integers(0, 2**64 - 1), max_size=300), st.sets(st.integers(0, 400)))
@settings(max_examples=60, deadline=None)
def test_differences_are_exact(a, b, common):
    a, b = (np.array(sorted(x | common), np.uint64) for x in (a, b))
    only_a, only_b = difference(a, b)
    assert sorted(only_a.tolist()) == sorted(set(a.tolist()) - set(b.tolist()))
    assert sorted(only_b.tolist()) == sorted(set(b.tolist()) - set(a.tolist()))


def test_small_differences_are_read_from_the_fingerprints():
    a = np.arange(1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    b = np.append(a[1:], np.uint64(5))
    sketches = [from_text(iblt.as_text(sketch(x))) for x in (a, b)]
    only_a, only_b = peel(sketches[0] - sketches[1])
    assert only_a.tolist() == a[:1].tolist() and only_b.tolist() == [5]


def test_large_differences_need_a_larger_sketch():
    a = iblt.mix(np.arange(100, dtype=np.uint64), 1)
    assert peel(sketch(a)) is None
    assert len(difference(a, a[:0])[0]) == 100


@given(st.text("ab. !\n\t", max_size=80), st.text("ab. !\n", max_size=30), st.integers(0, 80))
@settings(max_examples=300, deadline=None)
def test_paragraphs_are_taken_over(text, tail, same):
    same = min(same, len(text))
    edited = text[:same] + tail
    taken = iblt.Paragraphs(edited, iblt.Paragraphs(text), same)
    fresh = iblt.Paragraphs(edited)
    assert list(taken.hashes) == list(fresh.hashes) and taken.ends.tolist() == fresh.ends.tolist()


def test_repeated_paragraphs_count():
    assert len(digests("Yes. Yes. Yes.")) == 3
    assert likeness(digests("Yes. Yes. No."), digests("Yes. No.")) == pytest.approx(2 / 3)
    assert likeness(digests(""), digests(" \n")) == 1.0


def test_query_equals_brute_force(spark, sf_dir, sf_texts):
    rows = op6_fingerprints(spark, sf_dir)
    assert sorted(plain(rows)) == sorted(brute(list(sf_texts.items())))


def test_equal_texts_have_equal_fingerprints(make_docs):
    rows = fingerprint_rows(make_docs([(i, "Same text. Twice.") for i in range(9)])).collect()
    assert len({r.fingerprint for r in rows}) == 1
    assert all(r.near_next == 1.0 for r in rows)


@pytest.mark.parametrize("parts", ["1", "3", "16"])
def test_odd_rows_in_any_number_of_parts(spark, make_docs, parts):
    rows = [(None, "no id. at all"), (-5, "neg. ative"), (1, None), (2, ""), (3, "é🙂 x"), (7, "long words. " * 30_000), (9, "end.")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = plain(fingerprint_rows(make_docs(rows[::-1])))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(found, key=key) == brute(rows)


def test_one_row_repeated_rows_and_none(make_docs):
    assert plain(fingerprint_rows(make_docs([(4, "abcd efgh")]))) == brute([(4, "abcd efgh")])
    repeated = [(1, "one. two. three."), (1, "one. two. three."), (2, "other")]
    assert sorted(plain(fingerprint_rows(make_docs(repeated)))) == sorted(brute(repeated))
    assert fingerprint_rows(make_docs([])).count() == 0


def test_the_first_sketch_is_large_enough_for_unlike_texts(monkeypatch):
    """Neighbours that share nothing, or a part of their digests, are told apart at the first attempt."""
    draw, tried = np.random.default_rng(3), []
    keys = np.unique(draw.integers(0, 2**63, 1200).astype(np.uint64))
    draw.shuffle(keys)
    monkeypatch.setattr(iblt, "peel", lambda cells, salt=0: tried.append(salt) or peel(cells, salt))
    for common in (0, 100, 300):
        a, b = np.sort(keys[:400]), np.sort(keys[400 - common : 800 - common])
        only_a, only_b = difference(a, b)
        assert set(only_a) == set(a) - set(b) and set(only_b) == set(b) - set(a)
    assert tried == [0, 0, 0]
