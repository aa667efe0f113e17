"""SentencePiece encoding and decoding with weighted finite-state transducers.

The normaliser is a transducer from characters to characters, the vocabulary one from characters to
pieces, with a path through the bytes of a character that no piece covers. Both are composed with
each input on the fly, and the path of least weight is taken in the tropical semiring (weights add
along a path, the least of several paths counts).

A unigram vocabulary weighs each piece with its negative log probability. A vocabulary of merges (BPE)
is compiled into a transducer that remembers the piece before: an arc exists only if the
merges leave the two pieces as they are. A sequence all of whose neighbours pass this is the one that
merging gives, so exactly one path reaches each place, and the one to the end is the library's answer.
"""

from __future__ import annotations

import hashlib
import math
import re
import struct
from collections import Counter
from collections.abc import Callable, Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm.common import Recent, slices, table

BLANK = "▁"
# Fixed values of the model format: kinds of pieces, and kinds of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
# Words that a worker keeps twice at most, pairs that it keeps, and the length from which a word is not kept.
KEPT_WORDS, KEPT_PAIRS, LONG_WORD = 150_000, 400_000, 64
# Of a character that is written as bytes: more than any path of pieces.
BYTES_WEIGHT = 1e6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message: numbers as integers, the rest as bytes."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (data[at] & 0x7F) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 0x80:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        if tag & 7 == 0:
            value, at = number(at)
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            if size is None:
                size, at = number(at)
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Transducer:
    """A compiled model: encodes words and decodes ids."""

    def __init__(self, model: bytes):
        self.kinds, self.scores, self.texts = [], [], []
        trainer, normaliser = {}, {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.texts.append(piece.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        self.merges = trainer.get(3, UNIGRAM) == BPE
        if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or USER_DEFINED in self.kinds:
            raise ValueError("only models that leave characters and blanks as they are, without own symbols")
        self.prefix = BLANK if normaliser.get(3, 1) else ""
        ids = range(len(self.texts))
        self.of_piece = {self.texts[i]: i for i in ids if self.kinds[i] == NORMAL}
        self.of_byte = {int(self.texts[i][1:-1], 16): i for i in ids if self.kinds[i] == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self.codes = Recent(self._bytes, 0, 0)
        self.codes.update({piece: struct.pack("<I", i) for piece, i in self.of_piece.items()})
        self.word = self._words()
        # All pieces in one automaton: it follows every path of the vocabulary through a word at once. With merges,
        # a character alone is what is left where no longer piece fits, and needs no arc.
        self.automaton = ahocorasick.Automaton()
        self.halves: dict[str, int] = {}  # where the last merge of a piece joins two
        for piece in self.of_piece:
            if not self.merges or len(piece) > 1 and self._merged(piece, self.halves) == [piece]:
                self.automaton.add_word(piece, piece)
        if len(self.automaton):
            self.automaton.make_automaton()
        # Scores that pieces share, and pieces that do not merge in the order of scores of their own.
        self.shared = {x for x, n in Counter(map(self._score, self.of_piece)).items() if n > 1}
        self.loose: set[str] = set()
        for piece in sorted(self.halves, key=len):
            score, cut = self._score(piece), self.halves[piece]
            parts = [x for x in (piece[:cut], piece[cut:]) if len(x) > 1]
            if score in self.shared or any(x in self.loose or self._score(x) <= score for x in parts):
                self.loose.add(piece)
        self.sides: tuple[dict[str, list], dict[str, list]] = {}, {}
        self.words = Recent(self._word, KEPT_WORDS, LONG_WORD)
        self.pairs: dict[str, dict[str, bool]] = {}
        self.n_pairs = 0
        self.outputs = [self._output(i) for i in ids]

    def _score(self, piece: str) -> float:
        return self.scores[self.of_piece[piece]]

    def _words(self) -> re.Pattern:
        """Splits a text into words that can be composed apart, as no piece crosses from one to the next."""
        if any(BLANK in piece.lstrip(BLANK) for piece in self.of_piece):
            return re.compile("(?s).+")
        # Characters that stand in one piece, blanks before it aside, are in one group.
        groups: dict[str, set[str]] = {}
        for piece in self.of_piece:
            inner = piece.lstrip(BLANK)
            if len(inner) > 1 and not groups.get(inner[0], set()).issuperset(inner):
                joined = set(inner).union(*(groups.get(x, ()) for x in inner))
                groups.update(dict.fromkeys(joined, joined))
        different = sorted({id(x): x for x in groups.values()}.values(), key=len, reverse=True)
        runs = [f"[{re.escape(''.join(sorted(x)))}]+" for x in different]
        return re.compile(f"{BLANK}*(?:{'|'.join([*runs, f'[^{BLANK}]'])})|{BLANK}+")

    def _merged(self, text: str, halves: dict[str, int] | None = None) -> list[str]:
        """What merging the best pair of neighbours, the left one of equal ones, over and over leaves."""
        parts = list(text)
        while True:
            scored = [
                (-self.scores[self.of_piece[a + b]], i)
                for i, (a, b) in enumerate(zip(parts, parts[1:]))
                if a + b in self.of_piece
            ]
            if not scored:
                return parts
            i = min(scored)[1]
            if halves is not None and len(parts) == 2:
                halves[text] = len(parts[0])
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _follows(self, before: str, piece: str) -> bool:
        """Whether merging leaves the two pieces as they are; looked up if the pair came before."""
        known = self.pairs.setdefault(before, {})
        if piece not in known:
            self.n_pairs += 1
            if self.n_pairs > KEPT_PAIRS:
                self.pairs, self.n_pairs = {}, 1
            known[piece] = not before or self._apart(before, piece)
        return known[piece]

    def _side(self, piece: str, side: int) -> list[tuple[str, float, float]]:
        """The parts that stand at one end of a piece while it merges, with the scores they come and go at."""
        known = self.sides[side]
        if piece not in known:
            part, goes = piece, -math.inf
            known[piece] = []
            while len(part) > 1:
                comes = self._score(part)
                known[piece].append((part, comes, goes))
                cut = self.halves[part]
                part, goes = part[cut:] if side else part[:cut], comes
            known[piece].append((part, math.inf, goes))
        return known[piece]

    def _apart(self, before: str, piece: str) -> bool:
        """Whether no merge joins the end of one piece with the start of the next while both merge.

        Merges run from the highest score down, so a part at either end stands there between two scores, and a merge of
        two such parts happens if its turn is in the time of both; of equal merges the left one comes first.
        """
        if before in self.loose or piece in self.loose:
            return self._merged(before + piece) == [before, piece]
        starts = self._side(piece, 0)
        for end, end_comes, end_goes in self._side(before, 1):
            for start, start_comes, start_goes in starts:
                if (joined := end + start) in self.of_piece:
                    score = self._score(joined)
                    if score in self.shared:
                        return self._merged(before + piece) == [before, piece]
                    turn = min(score, end_comes, start_comes)
                    if turn > end_goes and turn >= start_goes:
                        return False
        return True

    def _arcs(self, word: str) -> list[list[tuple[int, str]]]:
        """For each place (end, piece) of its arcs, the longest last; a character without piece has one for its bytes."""
        arcs: list[list[tuple[int, str]]] = [[] for _ in word]
        for last, piece in self.automaton.iter(word) if len(self.automaton) else ():
            arcs[last + 1 - len(piece)].append((last + 1, piece))
        for place, found in enumerate(arcs, 1):
            if not found or found[0][0] > place:
                found.insert(0, (place, word[place - 1]))
        return arcs

    def shortest_path(self, word: str) -> list[str]:
        """The pieces of the path of least weight."""
        return self._only_path(word) if self.merges else self._least_path(word)

    def _least_path(self, word: str) -> list[str]:
        """Place by place, the least weight of a path to it and the arc it ends with."""
        states: list[tuple | None] = [(0.0, 0, "")] + [None] * len(word)
        for start, arcs in enumerate(self._arcs(word)):
            for end, piece in arcs:
                number = self.of_piece.get(piece)
                total = states[start][0] + (BYTES_WEIGHT if number is None else -self.scores[number])
                if states[end] is None or total < states[end][0]:
                    states[end] = (total, start, piece)
        path, at = [], len(word)
        while at:
            _, at, piece = states[at]
            path.append(piece)
        return path[::-1]

    def _only_path(self, word: str) -> list[str]:
        """A state is a place and the piece before it. One path reaches each place, so each has one state."""
        ends, pairs, none = ["", *word], self.pairs, {}
        for last, piece in self.automaton.iter(word) if len(self.automaton) else ():
            if len(ends[last + 1]) == 1:
                before = ends[last + 1 - len(piece)]
                fits = pairs.get(before, none).get(piece)
                if fits is None:
                    fits = self._follows(before, piece)
                if fits:
                    ends[last + 1] = piece
        path, at = [], len(word)
        while at:
            path.append(ends[at])
            at -= len(ends[at])
        return path[::-1]

    def _bytes(self, character: str) -> bytes:
        """The ids of a character that has no piece."""
        found = [self.of_byte.get(byte, self.unknown) for byte in character.encode("utf-8", "surrogatepass")]
        return struct.pack(f"<{len(found)}I", *found)

    def _word(self, word: str) -> bytes:
        return b"".join(map(self.codes.__getitem__, self.shortest_path(word)))

    def normalise(self, text: str) -> str:
        return self.prefix + text.replace(" ", BLANK) if text else ""

    def encode(self, text: str | None) -> np.ndarray:
        self.words.age()
        words = self.word.findall(self.normalise(text or ""))
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), "<i4")

    def _output(self, i: int) -> bytes:
        if self.kinds[i] == BYTE:
            return bytes([int(self.texts[i][1:-1], 16)])
        text = {UNKNOWN: " ⁇ ", CONTROL: ""}.get(self.kinds[i], self.texts[i].replace(BLANK, " "))
        return text.encode()

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, without the blank that encoding puts in front; broken characters become U+FFFD."""
        text = b"".join(map(self.outputs.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_compiled: dict[bytes, Transducer] = {}


def compiled(model: bytes) -> Transducer:
    key = hashlib.sha256(model).digest()
    if key not in _compiled:
        _compiled.clear()
        _compiled[key] = Transducer(model)
    return _compiled[key]


def encode(spark: SparkSession, model_path: str) -> Callable[[Column], Column]:
    """A function from a text column to a struct of `ids` and `decoded`, the text that the ids decode to.

    A null or empty text has no ids and decodes to an empty one. Decoding gives back what was encoded, but for U+2581,
    which stands for a blank in pieces and comes back as one. The driver reads the model, whose
    size does not depend on the data, and sends it to all tasks.
    """
    model = spark.sparkContext.broadcast(Path(model_path).read_bytes())

    @F.arrow_udf("ids array<int>, decoded string")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        transducer = compiled(model.value)
        for texts in slices(batches):
            ids = [transducer.encode(text) for text in texts]
            decoded = [transducer.decode(x) for x in ids]
            ends = pa.array(np.cumsum([0, *map(len, ids)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, "<i4"), *ids])))
            yield pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], ["ids", "decoded"])

    return encoded


def decode(spark: SparkSession, model_path: str) -> Callable[[Column], Column]:
    """A function from a column of ids to texts; null gives null."""
    model = spark.sparkContext.broadcast(Path(model_path).read_bytes())

    @F.arrow_udf("string")
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        transducer = compiled(model.value)
        for lists in batches:
            found = (None if x is None else transducer.decode(np.asarray(x, "<i4")) for x in lists.to_pylist())
            yield pa.array(list(found), pa.string())

    return decoded


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def with_pieces(docs: DataFrame, model_path: str) -> DataFrame:
    """The documents with `ids`, `n_tokens` and `decoded`; columns of these names are replaced."""
    found = encode(docs.sparkSession, model_path)(F.col("text"))
    rows = docs.select(F.struct("*").alias("row"), found.alias("found"))
    kept = [F.col("row")[name].alias(name) for name in docs.columns if name not in ("ids", "n_tokens", "decoded")]
    return rows.select(*kept, "found.ids", F.size("found.ids").alias("n_tokens"), "found.decoded")


def op5_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    found = with_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), model_path or default_model())
    return found.select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("round_trip"),
    )
