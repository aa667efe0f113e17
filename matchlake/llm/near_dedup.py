"""Near-duplicates by wide SimHash fingerprints and multi-index hashing, decided by exact Jaccard likeness.

Two documents are linked if the sets of their different five-word shingles have a Jaccard likeness of at least
0.8; the groups are the components of the links. Fingerprints only propose pairs.

Documents at 0.8 differ in about 15 % of the bits of a SimHash fingerprint, which is too many for exact
search among 64 bits. So the fingerprint has BITS bits, cut into SEGMENTS parts of WIDTH bits, each the key of a table that is
also looked up under the keys one bit away. Two documents at 0.8 meet there with probability 0.36, closer ones far more often. For those at the limit each document also has
BANDS keys of ROWS MinHash values, no value in two bands: two documents at 0.8 share one with probability 0.9998.

A large group is not written out in pairs. First each document is compared with the least and the greatest that share a
key with it. Then each is compared with one other of each of its index entries, drawn by a hash, unless links are known
to connect the two, and in entries of more than MEMBERS with the member that has the fewest shingles to itself, which is the likest to
all others. At last all pairs that an entry of at most MEMBERS holds are compared, but for those of one
component. Of larger entries those pairs are compared that the shingles do not rule out: with shingles in order of how many documents hold
them, two documents at 0.8 share one among the first few of both. So no partner is left out, and a group of near copies, by then one
component, costs its size, and so do its members that are too unlike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from matchlake.llm.common import slices
from matchlake.llm.components import components, nearer
from matchlake.llm.simhash import shingle_hashes
from matchlake.session import discard, materialise

WORDS, WIDTH = 6, 32
BITS = 64 * WORDS
SEGMENTS = BITS // WIDTH
# Two texts of likeness 0.8 have shingle vectors at a cosine of at least 0.889: 58 of 384 bits differ, 72 at most if ties
# of short texts count. This is only a gate before the exact test, five standard deviations (7.6 bits) above.
MAX_BITS = 110
BANDS, ROWS = 16, 4
VALUES = BANDS * ROWS
# The likeness that links, SHARE / OF; whole numbers, so that 0.8 itself is exact.
SHARE, OF = 4, 5
BLOCK = 1 << 14
# Members of an entry that are all compared; in larger entries the shingles rule out pairs first.
MEMBERS = 32
_draw = np.random.RandomState(7)
_XOR = _draw.randint(0, 1 << 62, VALUES).astype(np.uint64)[:, None]
_TIMES = (_draw.randint(0, 1 << 62, VALUES).astype(np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
_BANDS = np.arange(VALUES).reshape(BANDS, ROWS)
SKETCH = "node long, n long, print array<long>, bands array<long>"


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The hashes of the different shingles, in order."""
    blocks = [np.unique(hashes) for hashes in shingle_hashes(text, shingle, BLOCK)]
    return np.unique(np.concatenate(blocks)) if blocks else np.empty(0, np.uint64)


def print_of(different: np.ndarray) -> list[int]:
    ones = np.zeros((WORDS, 64), np.int64)
    for at in range(0, len(different), BLOCK):
        hashes = different[at : at + BLOCK]
        for word in range(WORDS):
            x = (hashes ^ np.uint64((word + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(32)
            ones[word] += np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(different), axis=1).view("<i8").ravel().tolist()


def wide_print(text: str | None, shingle: int) -> list[int]:
    """WORDS signed 64-bit numbers; all zero for a text without words."""
    return print_of(shingle_set(text, shingle))


def bands_of(different: np.ndarray) -> list[int]:
    """BANDS keys, above all segment keys; none for a text without words."""
    if not len(different):
        return []
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(different), BLOCK // 16):
        values = (different[None, at : at + BLOCK // 16] ^ _XOR) * _TIMES
        least = np.minimum(least, values.min(axis=1))
    keys = [xxh64_intdigest(least[of_band].tobytes(), n) for n, of_band in enumerate(_BANDS)]
    return [key >> 2 | 1 << 62 for key in keys]


def sketches(shingle: int) -> Callable[[Column], Column]:
    def of_text(text: str | None) -> tuple:
        different = shingle_set(text, shingle)  # one text's set at a time
        return xxh64_intdigest(different.tobytes()) - (1 << 63), len(different), print_of(different), bands_of(different)

    @F.pandas_udf(SKETCH)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [of_text(text) for text in texts]
            yield pd.DataFrame({
                name: pd.Series([row[i] for row in rows], dtype="int64" if i < 2 else object)
                for i, name in enumerate(("node", "n", "print", "bands"))
            })

    return of


def shingle_sets(shingle: int) -> Callable[[Column], Column]:
    @F.arrow_udf("array<long>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in slices(batches):
            sets = [shingle_set(text, shingle) for text in texts]
            ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))

    return of


def _segment(number: int) -> Column:
    """A segment as a number, with its own number above its bits."""
    word, shift = divmod(number * WIDTH, 64)
    low = F.shiftrightunsigned(F.col("print")[word], shift)
    return low.bitwiseAND(F.lit((1 << WIDTH) - 1)) + F.lit(number << WIDTH)


def _keyed(nodes: DataFrame, *columns: str) -> DataFrame:
    """A row for each key of each node: its segments and its bands."""
    segments = F.array(*[_segment(n) for n in range(SEGMENTS)])
    return nodes.select(*columns, F.explode(F.concat(segments, "bands")).alias("key"))


def _looked_up(nodes: DataFrame) -> DataFrame:
    """(node, key) of all segment keys one bit from a node's own, where the node has a zero.

    So of two segments that differ in one bit one is looked up under the other's key, and not the other way round.
    """
    segments = F.array(*[_segment(n) for n in range(SEGMENTS)])
    bits = F.array(*[F.lit(1 << bit) for bit in range(WIDTH)])
    near = F.transform(F.filter(bits, lambda bit: F.col("own").bitwiseAND(bit) == 0), lambda bit: F.col("own") + bit)
    return nodes.select("node", F.explode(segments).alias("own")).select("node", F.explode(near).alias("key"))


def _pairs(found: DataFrame) -> DataFrame:
    """(a, b) with a < b, once each, of (node, other)."""
    found = found.filter("node <> other")
    return found.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def shared_entries(nodes: DataFrame) -> DataFrame:
    """(node, key) of the keys that several nodes have or look up; all others lead nowhere."""
    own = _keyed(nodes, "node")
    entries = own.unionByName(_looked_up(nodes).join(own.select("key"), "key", "left_semi"))
    entries = materialise(entries)
    ends = entries.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = materialise(entries.join(ends.filter("least < most").select("key"), "key", "left_semi"))
    discard(entries)
    return shared


def star_pairs(entries: DataFrame) -> DataFrame:
    """(a, b): each node with the least and the greatest node of all entries that it stands in."""
    ends = entries.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    found = entries.join(ends, "key").groupBy("node").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    return _pairs(found.select("node", F.explode(F.array("least", "most")).alias("other")))


def crossing_entries(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, key, root) of the keys that nodes of several components (node, root) have."""
    rooted = entries.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    held = rooted.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    return materialise(rooted.join(held.select("key"), "key", "left_semi"))


def _hub_pairs(crossing: DataFrame, draw: Column) -> DataFrame:
    """(a, b): each node with the node of least `draw` of each of its entries, if of another component."""
    hubs = crossing.groupBy("key").agg(F.min(F.struct(draw, "node", "root")).alias("hub"))
    hubs = hubs.select("key", F.col("hub.node").alias("other"), F.col("hub.root").alias("of_root"))
    return _pairs(crossing.join(hubs, "key").filter("root <> of_root"))


def crossing_of(entries: DataFrame, stars: DataFrame) -> DataFrame:
    """`crossing_entries` by the stars (a, b) of links, each with the least b it has."""
    return crossing_entries(entries, stars.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")))


def drawn_pairs(crossing: DataFrame, number: int) -> DataFrame:
    """(a, b): each node with a node of each of its entries, which a hash draws for entry and round, if of another component."""
    return _hub_pairs(crossing, F.xxhash64("node", "key", F.lit(number)))


def large_entries(crossing: DataFrame) -> DataFrame:
    """(key) of the entries of more than MEMBERS nodes."""
    return crossing.groupBy("key").count().filter(F.col("count") > MEMBERS).select("key")


def ordered_shingles(large: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, n, alone, first) of the nodes of (node, key, root): how many shingles they have and have to themselves, and the first ones.

    The order is by the number of these nodes that hold a shingle, then by its hash. `first` has the place and hash of each that comes before a
    likeness of SHARE / OF is out of reach and that others hold too.
    """
    held = sets.join(large.select("node").distinct(), "node", "left_semi")
    each = materialise(held.select("node", F.explode("held").alias("shingle")))
    often = materialise(each.groupBy("shingle").agg(F.count("*").alias("often")).filter("often > 1"))
    place = F.struct(F.coalesce("often", F.lit(1)).alias("often"), "shingle")
    order = each.join(often, "shingle", "left").groupBy("node").agg(F.sort_array(F.collect_list(place)).alias("order"))
    n = F.size("order")
    reach = n - F.ceil(n * SHARE / OF).cast("int") + 1
    first = F.transform(F.slice("order", 1, reach), lambda x, i: F.struct(i.alias("place"), x.often.alias("often"), x.shingle.alias("shingle")))
    alone = F.size(F.filter("order", lambda x: x.often == 1))
    ordered = order.select(
        "node", n.alias("n"), alone.alias("alone"), F.filter(first, lambda x: x.often > 1).alias("first")
    )
    ordered = materialise(ordered)
    discard(each)
    discard(often)
    return ordered


def central_pairs(large: DataFrame, ordered: DataFrame) -> DataFrame:
    """(a, b): each node with the node of each of its entries that has the least share of shingles to itself."""
    return _hub_pairs(large.join(ordered, "node"), F.col("alone") / F.col("n"))


def shingle_pairs(large: DataFrame, ordered: DataFrame) -> DataFrame:
    """(a, b): the pairs of nodes of different components (node, key, root) that may have a likeness of SHARE / OF.

    Two sets at the limit share SHARE / (SHARE + OF) of the sum of their sizes. The first shingle that both hold must therefore have as
    many, itself included, behind it in both. Pairs that share no key are found as well.
    """
    rooted = large.select("node", "root").distinct().join(ordered, "node")
    rows = rooted.select("node", "root", "n", F.explode("first").alias("at"))
    rows = rows.select("node", "root", "n", (F.col("n") - F.col("at.place")).alias("left"), F.col("at.shingle").alias("shingle"))

    def within(left: str, sizes: Column) -> Column:
        return F.col(left) * (SHARE + OF) >= sizes * SHARE

    met = rows.groupBy("shingle").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.min("n").alias("least_n"))
    rows = rows.join(met.filter("least < most").select("shingle", "least_n"), "shingle")
    rows = materialise(rows.filter(within("left", F.col("n") + F.col("least_n"))).drop("least_n"))
    # Whole components first: an entry that one of them fills is one row here, and meets no node of its own.
    others = rows.groupBy("shingle", F.col("root").alias("of_root")).agg(F.min("n").alias("least_n"), F.max("left").alias("most_left"))
    sizes = F.col("n") + F.col("least_n")
    near = (F.col("root") < F.col("of_root")) & within("left", sizes) & within("most_left", sizes)
    met = rows.join(others, "shingle").filter(near).drop("least_n", "most_left", "root")
    members = rows.select(
        "shingle", F.col("root").alias("of_root"), F.col("node").alias("other"), F.col("n").alias("of_n"), F.col("left").alias("of_left")
    )
    sizes = F.col("n") + F.col("of_n")
    return _pairs(met.join(members, ["shingle", "of_root"]).filter(within("left", sizes) & within("of_left", sizes)))


def pairs_between(crossing: DataFrame) -> DataFrame:
    """(a, b): all pairs of nodes of different components that share a key, of (node, key, root)."""
    # An entry that one component fills is one row here, and meets no node of its own.
    others = crossing.select("key", F.col("root").alias("of_root")).distinct()
    met = crossing.join(others, "key").filter("root < of_root").select("key", "of_root", "node")
    members = crossing.select("key", F.col("root").alias("of_root"), F.col("node").alias("other"))
    return _pairs(met.join(members, ["key", "of_root"]))


def verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, max_bits: int) -> DataFrame:
    """The pairs whose different shingles have a Jaccard likeness of SHARE / OF or more."""
    left = nodes.select(F.col("node").alias("a"), F.col("print").alias("print_a"), F.col("n").alias("n_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("print").alias("print_b"), F.col("n").alias("n_b"))
    differ = [F.bit_count(F.col("print_a")[i].bitwiseXOR(F.col("print_b")[i])) for i in range(WORDS)]
    sizes = F.least("n_a", "n_b") * OF >= F.greatest("n_a", "n_b") * SHARE
    likely = pairs.join(left, "a").join(right, "b").filter(sizes & (sum(differ[1:], differ[0]) <= max_bits))
    likely = materialise(likely.select("a", "b"))

    ends = likely.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = materialise(ends)  # of known size: few meet the sets in place
    known = sets.join(needed, "node", "left_semi")

    def held(end: str) -> DataFrame:
        return known.select(F.col("node").alias(end), F.col("held").alias(f"held_{end}"))

    both = likely.join(held("a"), "a").join(held("b"), "b")
    both = both.withColumn("shared", F.size(F.array_intersect("held_a", "held_b")).cast("long"))
    union = F.size("held_a") + F.size("held_b") - F.col("shared")
    linked = materialise(both.filter(F.col("shared") * OF >= union * SHARE).select("a", "b"))
    discard(likely)
    discard(needed)
    return linked


def near_groups(docs: DataFrame, shingle: int = 5, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, version, root) for each row: rows with the same root are near-duplicates.

    `version` is a hash of the text. Texts with the same words, but for case of A-Z and white space, are always together; so are
    null, empty and blank ones. Other columns are ignored. An empty table gives an empty one.
    """
    prints = docs.select("doc_id", F.xxhash64("text").alias("version"), sketches(shingle)(F.col("text")).alias("of"))
    prints = materialise(prints.select("doc_id", "version", "of.*"))
    of = F.min(F.struct(F.col("doc_id").alias("of_id"), F.col("version").alias("of_version"))).alias("of")
    held = [F.any_value(name).alias(name) for name in ("n", "print", "bands")]
    nodes = materialise(prints.groupBy("node").agg(of, *held))
    entries = shared_entries(nodes)
    sets = shingle_sets_of(nodes.join(entries.select("node").distinct(), "node", "left_semi"), docs, shingle)
    links = verified(star_pairs(entries), nodes, sets, max_bits)
    crossing = crossing_of(entries, links := nearer(links))
    links = links.unionByName(verified(drawn_pairs(crossing, 0), nodes, sets, max_bits))
    discard(crossing)
    crossing = crossing_of(entries, links := nearer(links))
    large = materialise(crossing.join(large_entries(crossing), "key", "left_semi"))
    ordered = ordered_shingles(large, sets)
    links = links.unionByName(verified(central_pairs(large, ordered), nodes, sets, max_bits))
    discard(crossing)
    discard(large)
    # A component only grows, so whatever entry crosses components from here on did so before, and has its shingles ordered.
    crossing = crossing_entries(entries, components(links))
    of_large = materialise(large_entries(crossing))
    found = pairs_between(crossing.join(of_large, "key", "left_anti"))
    found = found.unionByName(shingle_pairs(crossing.join(of_large, "key", "left_semi"), ordered)).distinct()
    linked = components(links.unionByName(verified(found, nodes, sets, max_bits)))
    discard(crossing)
    discard(ordered)
    rows = prints.select("doc_id", "version", "node").join(linked, "node", "left")
    return rows.select("doc_id", "version", F.coalesce("root", "node").alias("root"))


def shingle_sets_of(nodes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(node, held): the hashes of the different shingles of each node."""
    ends = nodes.select("node", "of.*")
    whole = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version"))
    texts = whole.join(ends, same).dropDuplicates(["node"])
    return materialise(texts.select("node", shingle_sets(shingle)(F.col("text")).alias("held")))


def one_of_each_group(docs: DataFrame, **settings) -> DataFrame:
    """One document of each group, all columns as they are: the one with the smallest id.

    Rows without id stay only if no other of the group has one; of rows that repeat an id and text one stays.
    """
    groups = near_groups(docs, **settings).groupBy("root", "doc_id", "version").agg(F.count("*").alias("rows"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "version", "rows")
    kept = groups.groupBy("root").agg(F.min(order).alias("first")).select(
        F.col("first.doc_id").alias("of_id"), F.col("first.version").alias("of_version"), F.col("first.rows").alias("rows")
    )
    kept = materialise(kept)
    whole = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("version"))
    same = F.col("row.doc_id").eqNullSafe(F.col("of_id")) & (F.col("version") == F.col("of_version"))
    single = whole.join(kept.filter("rows = 1"), same, "left_semi").select("row.*")
    repeated = whole.join(kept.filter("rows > 1"), same).groupBy("of_id", "of_version")
    return single.unionByName(repeated.agg(F.first("row").alias("row")).select("row.*"))
