import random

import pytest
from xxhash import xxh64_intdigest

from matchlake.llm.components import components
from matchlake.llm.near_dedup import near_groups, one_of_each_group, wide_print
from matchlake.llm.simhash import fingerprint_of, links, op7_simhash, simhash_groups


def brute_fingerprint(text, shingle=3):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(len(words) - shingle + 1, 1))] if words else []
    hashes = [xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {node: node for node in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        if a == b:
            continue
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {node: find(node) for node in nodes}


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "one", "one two", "One two THREE", "a b c a b c a b c", "é ÉCOLE\x0bx\x1cy z", "w " * 1000]
)
def test_fingerprints(text):
    assert fingerprint_of(text, 3) % 2**64 == brute_fingerprint(text)


def test_long_texts_are_counted_in_blocks(monkeypatch):
    from matchlake.llm import simhash

    text = " ".join(f"w{i % 97}" for i in range(1000))
    whole = fingerprint_of(text, 3)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    assert fingerprint_of(text, 3) == whole


@pytest.mark.parametrize(("max_bits", "segments"), [(3, 2), (3, 4), (1, 2), (0, 2)])
def test_links_equal_brute_force(spark, max_bits, segments):
    draw = random.Random(max_bits)
    prints = {0, 2**63, 2**64 - 1}
    for _ in range(30):
        centre = draw.getrandbits(64)
        prints |= {centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for _ in range(6)}
    signed = sorted(x - 2**64 if x >= 2**63 else x for x in prints)
    df = spark.createDataFrame([(x,) for x in signed], "print long")
    rows = [tuple(sorted(r)) for r in links(df, max_bits, segments).collect()]
    expected = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) % 2**64).bit_count() <= max_bits
    }
    assert len(rows) == len(set(rows)) and set(rows) == expected


def test_components_equal_brute_force(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)]
    edges += [(400 + i, 401 + i) for i in range(40)] + [(-1, 500 + i) for i in range(60)] + [(7, 7), (500, -1)]
    df = spark.createDataFrame(edges, "a long, b long")
    expected = brute_components({x for a, b in edges if a != b for x in (a, b)}, edges)
    assert {r.node: r.root for r in components(df).collect()} == expected
    assert components(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark, sf_dir, sf_texts):
    prints = {i: brute_fingerprint(text) for i, text in sf_texts.items()}
    linked = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    root = brute_components(prints, linked)
    rows = op7_simhash(spark, sf_dir).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        i: (f"{prints[i]:016x}", root[i]) for i in prints
    }


def test_odd_rows(make_docs):
    rows = [(3, "a b c d"), (2, "A  b\nc d"), (2, "A  b\nc d"), (None, "a b c d"), (9, None), (8, ""), (None, "alone here")]
    found = simhash_groups(make_docs(rows)).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in found if r.component_id) == [
        (0, 2), (2, 2), (2, 2), (3, 2), (8, 8), (9, 8)
    ]
    assert [r.doc_id for r in found if r.component_id is None] == [None]
    assert simhash_groups(make_docs([])).count() == 0


def varied(words, draw, share):
    return " ".join(draw.choice(words) + "x" if draw.random() < share else word for word in words)


def test_near_duplicates_are_grouped_and_others_are_not(make_docs):
    draw = random.Random(3)
    rows, group = [], {}
    for g in range(25):
        words = [f"g{g}w{draw.randrange(200)}" for _ in range(200)]
        for n in range(6):
            group[len(rows)] = g
            rows.append((len(rows), " ".join(words) if n == 0 else varied(words, draw, 0.01)))
    roots = {r.doc_id: r.root for r in near_groups(make_docs(rows)).collect()}
    pairs = [(a, b) for a in group for b in group if a < b]
    same = [(a, b) for a, b in pairs if group[a] == group[b]]
    assert sum(roots[a] == roots[b] for a, b in same) >= 0.9 * len(same)
    assert not any(roots[a] == roots[b] for a, b in pairs if group[a] != group[b])


def test_one_document_of_each_group_stays(make_docs):
    long = " ".join(f"w{i}" for i in range(100_000))
    rows = [(5, "one two three four five six"), (4, "One two  three four five six"), (None, "one two three four five six")]
    rows += [(7, None), (6, ""), (None, None), (1, long), (2, long + " "), (3, "else"), (3, "else"), (None, "no id"), (None, "no id")]
    docs = make_docs(rows)
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 3, 4, 6]
    assert one_of_each_group(make_docs([])).count() == 0


def test_wide_prints_differ_in_all_parts():
    print_ = wide_print("some words of a text", 5)
    assert len(set(print_)) == len(print_) == 6
    assert wide_print(None, 5) == [0] * 6
