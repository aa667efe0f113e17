import random

import pytest
from pyspark.sql import functions as F

from matchlake.llm.near_dedup import (
    MEMBERS,
    crossing_entries,
    drawn_pairs,
    near_groups,
    ordered_shingles,
    pairs_between,
    shared_entries,
    shingle_pairs,
    sketches,
    star_pairs,
)


def shingles(text, n=5):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1))}


def likeness(x, y):
    x, y = shingles(x), shingles(y)
    return len(x & y) / len(x | y)


def varied(words, draw, n):
    words = list(words)
    for i in draw.sample(range(len(words)), n):
        words[i] = f"other{draw.randrange(10**9)}"
    return words


def twos(low, high, n, seed):
    """Pairs of texts with a likeness from low to high."""
    draw, found = random.Random(seed), []
    while len(found) < n:
        words = [f"p{len(found)}w{draw.randrange(10**6)}" for _ in range(draw.choice([60, 200, 600]))]
        x, y = " ".join(words), " ".join(varied(words, draw, max(1, round(len(words) * draw.uniform(0.01, 0.06)))))
        if low <= likeness(x, y) <= high:
            found.append((x, y))
    return found


def together(make_docs, found):
    rows = [(i, text) for i, text in enumerate(text for two in found for text in two)]
    roots = {r.doc_id: r.root for r in near_groups(make_docs(rows)).collect()}
    return sum(roots[2 * i] == roots[2 * i + 1] for i in range(len(found))), len(set(roots.values()))


def test_pairs_just_above_the_limit_are_found(make_docs):
    same, groups = together(make_docs, twos(0.8, 0.85, 200, 1))
    assert same >= 0.97 * 200
    assert groups == 400 - same


def test_pairs_below_the_limit_are_not_linked(make_docs):
    assert together(make_docs, twos(0.7, 0.7999, 200, 2)) == (0, 400)


def test_the_limit_itself_links(make_docs):
    # 8 shingles of which 8 are among the other's 10: exactly 0.8; then 7 of 9.
    words = [f"w{i}" for i in range(14)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:12])), (3, "a b c d e f g h i j k l m"), (4, "a b c d e f g h i j k")]
    roots = {r.doc_id: r.root for r in near_groups(make_docs(rows)).collect()}
    assert roots[1] == roots[2] and roots[3] != roots[4]


@pytest.mark.parametrize("members", [5, 40])
def test_no_member_of_an_entry_is_left_out(spark, members):
    """Nodes that share one band key only: every pair of different components is a candidate."""
    rows = [(n, [n * 0x0101010101 + k for k in range(6)], [1 << 62]) for n in range(members)]
    nodes = spark.createDataFrame(rows, "node long, print array<long>, bands array<long>")
    roots = spark.createDataFrame([(0, 0), (1, 0), (2, 0)], "node long, root long")
    entries = shared_entries(nodes)
    crossing = crossing_entries(entries, roots)
    found = {(r.a, r.b) for r in pairs_between(crossing).collect()}
    joined = {(0, 1), (0, 2), (1, 2)}
    assert found == {(a, b) for a in range(members) for b in range(a + 1, members)} - joined
    assert star_pairs(entries).count() <= 2 * members
    drawn = {(r.a, r.b) for r in drawn_pairs(crossing, 1).collect()}
    assert drawn <= found and len(drawn) >= members - 3


def test_a_pair_inside_a_large_entry_is_found(make_docs):
    """Texts that share most of their words but are below the limit to each other, and copies of some."""
    draw = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for g in range(30):
        words = varied(base, draw, 12)
        rows += [(2 * g, " ".join(words)), (2 * g + 1, " ".join(varied(words, draw, 2)))]
    roots = {r.doc_id: r.root for r in near_groups(make_docs(rows)).collect()}
    texts = dict(rows)
    for a in texts:
        for b in texts:
            if likeness(texts[a], texts[b]) >= 0.8:
                assert roots[a] == roots[b]
    assert len(set(roots.values())) > 20


def test_texts_with_the_same_shingles_are_one_node(make_docs):
    docs = make_docs([(1, "a b c d e"), (2, "A  b c\td e"), (3, None), (4, " ")])
    nodes = {r.doc_id: r.of.node for r in docs.select("doc_id", sketches(5)(F.col("text")).alias("of")).collect()}
    assert nodes[1] == nodes[2] and nodes[3] == nodes[4] != nodes[1]


def test_segments_one_bit_apart_share_an_entry(spark):
    """Nodes that are far from each other in all segments but one, where they differ in one bit, any of its bits."""
    for bit in (0, 31, 32, 63):
        far = [0x123456789ABCDEF0 * (k + 1) % 2**62 for k in range(6)]
        near = [~x for x in far]
        near[2] = far[2] ^ (1 << bit) ^ (0xFFFF << (0 if bit >= 32 else 32))  # the word's other segment is far too
        rows = [(n, [x - 2**64 if x >= 2**63 else x for x in of], []) for n, of in enumerate((far, near))]
        nodes = spark.createDataFrame(rows, "node long, print array<long>, bands array<long>")
        assert {r.node for r in shared_entries(nodes).collect()} == {0, 1}


def numbered(draw, members, base, most):
    """Sets of `base` numbers of which up to `most` are others that no set shares."""
    sets = []
    for n in range(members):
        other = draw.randint(0, most)
        sets.append(sorted(draw.sample(range(base), base - other)) + [base + 1000 * n + i for i in range(other)])
    return sets


def large_entry(spark, sets, roots):
    large = spark.createDataFrame([(n, 1, root) for n, root in enumerate(roots)], "node long, key long, root long")
    held = spark.createDataFrame(list(enumerate(sets)), "node long, held array<long>")
    found = shingle_pairs(large, ordered_shingles(large, held))
    return {(r.a, r.b) for r in found.collect()}


def like(x, y):
    return 5 * len(set(x) & set(y)) >= 4 * len(set(x) | set(y))


def test_shingles_leave_out_no_pair_at_the_limit(spark):
    draw = random.Random(3)
    sets = numbered(draw, 30, 40, 7) + numbered(draw, 30, 43, 7) + numbered(draw, 10, 35, 2)
    roots = [n if n % 3 else 0 for n in range(len(sets))]
    found = large_entry(spark, sets, roots)
    wanted = {(a, b) for b in range(len(sets)) for a in range(b) if roots[a] != roots[b] and like(sets[a], sets[b])}
    assert wanted and wanted <= found
    assert all(roots[a] != roots[b] for a, b in found)


def test_members_of_a_large_entry_that_are_too_unlike_are_not_paired(spark):
    """A component and many members with too many shingles of their own: before, each met each."""
    draw = random.Random(4)
    joined = numbered(draw, 100, 100, 3)
    unlike = [sorted(draw.sample(range(100), 80)) + [9 * 10**6 + 100 * n + i for i in range(20)] for n in range(100)]
    roots = [0] * 100 + list(range(100, 200))
    assert len(roots) > MEMBERS and not large_entry(spark, joined + unlike, roots)


def test_a_large_entry_is_grouped_as_by_all_pairs(make_docs):
    draw = random.Random(6)
    base = [f"b{i}" for i in range(300)]
    rows = [(n, " ".join(varied(base, draw, draw.choice([1, 2, 4, 6, 8, 10, 14])))) for n in range(3 * MEMBERS)]
    roots = {r.doc_id: r.root for r in near_groups(make_docs(rows)).collect()}
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for b in range(len(rows)):
        for a in range(b):
            if group[a] != group[b] and like(sets[a], sets[b]):
                group = [group[a] if g == group[b] else g for g in group]
    assert len(set(group)) > 1
    assert len(set(roots.values())) == len(set(group)) == len({(roots[n], group[n]) for n in roots})
