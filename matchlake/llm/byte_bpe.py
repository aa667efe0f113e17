"""Byte-level BPE encoding and decoding by tree reduction.

What a stretch of text encodes to is an element of a monoid, and joining the elements of two neighbours gives that of both
together. So a text is encoded by halves: the parts are encoded on their own and joined in pairs up a tree. There are two levels.

* Text: the element is the list of the pattern's matches. A match has looked at most PEEK characters past its end, so all
  matches of the left part that end earlier are those of the whole. From there matching goes on into the right part, until
  a match ends where one of the right part ends: matching looks ahead only, so the rest is the right part's.
* Match: the element is the tokens of its bytes. Of both neighbours a window at the boundary is merged anew. A sequence is
  what merging gives if and only if merging leaves each two neighbours in it as they are: the first merge across
  a boundary would also be the first one across it in the two neighbours alone. So the tokens outside the window
  stand once they fit those at its ends; until then the window doubles on the side that does not.

Decoding concatenates bytes up a tree of halves.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import Recent, slices, table

# Characters of text, and tokens, that are not halved any more; bytes of a match that are merged directly.
LEAF_CHARS, LEAF_IDS, LEAF_BYTES = 1 << 14, 1 << 14, 32
# Up to so many bytes it is faster to look through all pairs than to keep them in order.
SHORT_BYTES = 64
# The most characters past its end that a match of the pattern depends on: a blank run gives one back and looks at the next,
# a quote tries two letters after it.
PEEK = 2
# Matches that a worker keeps twice at most, pairs that it keeps, and the length from which a match is not kept.
KEPT_WORDS, KEPT_PAIRS, LONG_WORD = 150_000, 200_000, 64


def merged(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ranks left when the pair of neighbours with the least rank, the left one of equal ones, is merged over and over."""
    return _merged_long(data, ranks) if len(data) > SHORT_BYTES else _merged_short(data, ranks)


def _merged_short(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """`merged` by looking through all pairs for each merge."""
    rank_of, none = ranks.get, len(ranks) + 1
    parts = [data[i : i + 1] for i in range(len(data))]
    pairs = [rank_of(data[i : i + 2], none) for i in range(len(data) - 1)]
    pairs.append(none)  # the last part has no neighbour
    while (least := min(pairs)) < none:
        i = pairs.index(least)
        parts[i] = part = parts[i] + parts.pop(i + 1)
        del pairs[i]
        if i + 1 < len(parts):
            pairs[i] = rank_of(part + parts[i + 1], none)
        if i:
            pairs[i - 1] = rank_of(parts[i - 1] + part, none)
    return [ranks[part] for part in parts]


def _merged_long(data: bytes, ranks: dict[bytes, int]) -> list[int]:
    """`merged` in n log n steps for n bytes."""
    n = len(data)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    end_of = list(range(1, n + 1))  # of the part that begins at a place; 0 for a place inside a part
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(data[i : i + 2])) is not None]
    heapify(heap)

    def offer(i: int) -> None:
        if i >= 0 and (j := after[i]) < n and (rank := ranks.get(data[i : end_of[j]])) is not None:
            heappush(heap, (rank, i, end_of[j]))

    while heap:
        _, i, end = heappop(heap)
        j = after[i]
        if not end_of[i] or j >= n or end_of[j] != end:
            continue  # one of the two has been merged since
        end_of[i], end_of[j] = end, 0
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    found, i = [], 0
    while i < n:
        found.append(ranks[data[i : end_of[i]]])
        i = after[i]
    return found


class ByteBpe:
    """A vocabulary of ranks with its pattern: encodes texts and decodes ids.

    `ranks` is a file of lines with a token in base64 and its rank; all 256 bytes must be tokens. `pattern` must match any
    character, look ahead only, and by PEEK characters at most. What is a letter is up to the installed `regex` module;
    its Unicode version may be another one than that of other libraries.
    """

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("every byte must be a token")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.words = Recent(self._word, KEPT_WORDS, LONG_WORD)
        self.pairs: dict[tuple[int, int], bool] = {}

    def _fit(self, a: int, b: int) -> bool:
        """Whether merging leaves the two tokens as they are."""
        if (a, b) not in self.pairs:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = merged(self.tokens[a] + self.tokens[b], self.ranks) == [a, b]
        return self.pairs[a, b]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of the bytes of both, which must not be empty."""
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            middle = merged(b"".join(map(self.tokens.__getitem__, left[-i:] + right[:j])), self.ranks)
            left_fits = i == len(left) or self._fit(left[-i - 1], middle[0])
            right_fits = j == len(right) or self._fit(middle[-1], right[j])
            if left_fits and right_fits:
                return left[:-i] + middle + right[j:]
            i, j = i if left_fits else 2 * i, j if right_fits else 2 * j

    def tree(self, data: bytes) -> list[int]:
        """The ids of the bytes of one match."""
        if len(data) <= LEAF_BYTES:
            return merged(data, self.ranks)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def _word(self, word: str) -> bytes:
        data = word.encode()
        whole = self.ranks.get(data)  # one that is a token stays one, whatever merging gives
        ids = self.tree(data) if whole is None else [whole]
        return pack(f"<{len(ids)}I", *ids)

    def matches(self, text: str, start: int, stop: int) -> list[str]:
        """The pattern's matches in a stretch of a text, as if there were nothing else."""
        if stop - start <= LEAF_CHARS:
            return self.pattern.findall(text, start, stop)
        half = (start + stop) // 2
        found, right = self.matches(text, start, half), self.matches(text, half, stop)
        end = half
        while found and end > half - PEEK:
            end -= len(found.pop())
        place, known = 0, half  # so many of the right part's matches end at or before `known`
        for match in self.pattern.finditer(text, end, stop):
            found.append(match.group())
            while known < match.end():
                known += len(right[place])
                place += 1
            if known == match.end():
                break
        return found + right[place:]

    def encode(self, text: str | None) -> bytes:
        """The ids, packed as little-endian unsigned 32-bit integers."""
        self.words.age()
        return b"".join(map(self.words.__getitem__, self.matches(text or "", 0, len(text or ""))))

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids; an id that is none raises KeyError."""

        def up(ids: list[int]) -> bytes:
            if len(ids) <= LEAF_IDS:
                return b"".join(map(self.tokens.__getitem__, ids))
            half = len(ids) // 2
            return up(ids[:half]) + up(ids[half:])

        return up(np.frombuffer(packed, "<u4").tolist())


_compiled: dict[tuple[bytes, str], ByteBpe] = {}


def compiled(ranks: bytes, pattern: str) -> ByteBpe:
    """The vocabulary, built once a worker; another one takes its place."""
    key = hashlib.sha256(ranks).digest(), pattern
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = ByteBpe(ranks, pattern)
    return _compiled[key]


def coder(spark: SparkSession, ranks_path: str, pattern: str) -> Callable[[Column], Column]:
    """A function from a text column to a struct of `ids`, packed, and `decoded`, the bytes that the ids decode to.

    A null or empty text has no ids and decodes to no bytes. The driver reads the vocabulary, whose size
    does not depend on the data, and sends it to all tasks.
    """
    ranks = spark.sparkContext.broadcast(Path(ranks_path).read_bytes())

    @F.arrow_udf("ids binary, decoded binary")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = compiled(ranks.value, pattern)
        for texts in slices(batches):
            ids = [model.encode(text) for text in texts]
            decoded = [model.decode(packed) for packed in ids]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(decoded, pa.binary())], ["ids", "decoded"])

    return coded


def decoder(spark: SparkSession, ranks_path: str, pattern: str) -> Callable[[Column], Column]:
    """A function from a column of packed ids to bytes; null gives null, and an id that is none fails the job."""
    ranks = spark.sparkContext.broadcast(Path(ranks_path).read_bytes())

    @F.arrow_udf("binary")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = compiled(ranks.value, pattern)
        for packed in batches:
            yield pa.array([None if x is None else model.decode(x) for x in packed.to_pylist()], pa.binary())

    return decoded


def with_byte_bpe(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """The documents with `ids` (packed little-endian unsigned 32-bit integers), `n_tokens` and `decoded` bytes.

    Columns of these names are replaced, all others stay, and so do all rows, repeated ones and those without id too. A null
    text is an empty one. An empty table gives an empty one. A text of any length is coded whole; its work grows with n log n,
    and a match without end, such as the same letter a million times, with n log^2 n at worst.
    """
    found = coder(docs.sparkSession, ranks_path, pattern)(F.col("text"))
    rows = docs.select(F.struct("*").alias("row"), found.alias("found"))
    kept = [F.col("row")[name].alias(name) for name in docs.columns if name not in ("ids", "n_tokens", "decoded")]
    n_tokens = (F.octet_length("found.ids") / 4).cast("long")
    return rows.select(*kept, "found.ids", n_tokens.alias("n_tokens"), "found.decoded")


def op11_byte_bpe(spark: SparkSession, sf_dir: str, ranks_path: str | None = None) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document; odd rows as in `with_byte_bpe`."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = with_byte_bpe(docs, ranks_path, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
