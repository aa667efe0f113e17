import math
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from matchlake.llm.pieces import Transducer, decode, default_model, op5_sentencepiece, with_pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TRANSDUCER = Transducer(Path(MODEL).read_bytes())
ODD = [
    "", " ", "  hi  there\n x", "🙂🙂 naïve\tcafé ", "a" * 60, "=========----", "日本語テキスト", "́e", "x\x00y", "<s> </s>",
    "the" * 50, "ÀÉÎ ​ word", "�",
]


@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
@settings(max_examples=200, deadline=None)
def test_any_text_encodes_as_in_the_library_and_comes_back(text):
    ids = TRANSDUCER.encode(text)
    assert ids.tolist() == LIBRARY.encode(text)
    assert TRANSDUCER.decode(ids) == LIBRARY.decode(ids.tolist()) == text.replace("▁", " ")


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    ids = TRANSDUCER.encode(text)
    assert ids.tolist() == LIBRARY.encode(text)
    assert TRANSDUCER.decode(ids) == text


def field(number, value):
    def varint(n):
        out = b""
        while True:
            out, n = out + bytes([n & 0x7F | (0x80 if n > 0x7F else 0)]), n >> 7
            if not n:
                return out

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        import struct

        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(pieces):
    """A model with byte fallback and the given pieces and scores."""
    entries = [("<unk>", 0.0, 2), *((f"<0x{b:02X}>", 0.0, 6) for b in range(256)), *((p, s, 1) for p, s in pieces.items())]
    data = b"".join(
        field(1, field(1, text.encode()) + field(2, score) + field(3, kind)) for text, score, kind in entries
    )
    return data + field(2, field(3, 1)) + field(3, field(3, 1) + field(4, 0) + field(5, 1))


def test_unigram_takes_the_path_of_least_weight():
    pieces = {"▁": -4.0, "a": -3.0, "b": -3.0, "ab": -4.0, "▁a": -3.5, "ba": -5.5, "bab": -6.0, "▁ab": -9.0}
    transducer = Transducer(unigram_model(pieces))

    def brute(text):
        if not text:
            return [(0.0, [])]
        return [
            (weight - pieces[text[:n]], [text[:n], *rest])
            for n in range(1, len(text) + 1)
            if text[:n] in pieces
            for weight, rest in brute(text[n:])
        ]

    for text in ("ab", "abab", "babba", "aabbab"):
        best = min(brute("▁" + text))
        path = transducer.shortest_path("▁" + text)
        assert math.isclose(sum(-pieces[p] for p in path), best[0])
    assert transducer.decode(transducer.encode("ab é")) == "ab é"


def merge_model(pieces):
    return unigram_model(pieces) + field(2, field(3, 2) + field(35, 1))


def test_words_are_cut_where_no_piece_crosses():
    words = TRANSDUCER.word.findall("▁the.\n▁of$$$日本▁▁")
    assert words == ["▁the", ".", "\n", "▁of", "$$$", "日", "本", "▁▁"]
    pieces = {"ab": -1.0, "bc": -2.0, "▁x": -3.0, "dd": -4.0}
    for model in (unigram_model(pieces), merge_model(pieces)):
        assert Transducer(model).word.findall("▁caxddd-▁x▁") == ["▁ca", "x", "ddd", "-", "▁x", "▁"]


def test_pairs_are_told_by_scores_without_merging_anew(monkeypatch):
    transducer, merged = Transducer(Path(MODEL).read_bytes()), []
    monkeypatch.setattr(Transducer, "_merged", lambda self, text, *_: merged.append(text))
    texts = ["Unwahrscheinlichkeitsrechnung thonrecionement", "incomprehensibilities; internationalisation"]
    assert [transducer.encode(text).tolist() for text in texts] == [LIBRARY.encode(text) for text in texts]
    assert not merged and transducer.n_pairs


letters = st.text("ab▁c", min_size=1, max_size=5)


@given(
    st.dictionaries(letters, st.integers(-9, -1).map(float) | st.floats(-9, -1, width=32), max_size=25),
    st.lists(st.text("abc d", max_size=14), max_size=5),
)
@settings(max_examples=300, deadline=None)
def test_any_merges_give_what_the_library_and_merging_give(pieces, texts):
    """Scores may be shared, and those of a piece may come before those of its parts."""
    model = merge_model({"a": -20.0, "b": -21.0, "▁": -22.0} | pieces)
    transducer, library = Transducer(model), sentencepiece.SentencePieceProcessor(model_proto=model)
    for before in transducer.halves:
        for piece in transducer.halves:
            assert transducer._apart(before, piece) == (transducer._merged(before + piece) == [before, piece])
    for text in texts:
        ids = transducer.encode(text)
        assert ids.tolist() == library.encode(text)
        whole = transducer._merged(transducer.normalise(text))
        assert ids.tobytes() == b"".join(map(transducer.codes.__getitem__, whole))


def test_models_beyond_the_method_are_refused():
    with pytest.raises(ValueError, match="unigram and BPE"):
        Transducer(field(1, field(1, b"<unk>") + field(3, 2)) + field(2, field(3, 4)))
    with pytest.raises(ValueError, match="as they are"):
        Transducer(field(1, field(1, b"<unk>") + field(3, 2)) + field(3, field(2, b"map")))


def test_query_equals_the_library(spark, sf_dir, sf_texts):
    import hashlib

    expected = {}
    for i, text in sf_texts.items():
        ids = LIBRARY.encode(text)
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected[i] = (len(ids), digest, hashlib.sha256(text.encode()).hexdigest(), True)
    rows = op5_sentencepiece(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.round_trip) for r in rows} == expected


def test_rows_and_columns_stay(make_docs):
    docs = make_docs([(1, None), (1, ""), (None, "a b"), (2, "long " * 50_000), (2, "x" * 3000)])
    found = with_pieces(docs, default_model())
    assert found.columns == [*(c for c in docs.columns if c != "ids"), "ids", "n_tokens", "decoded"]
    rows = {(r.text or "")[:5]: r for r in found.collect()}
    assert rows[""].ids == [] and rows[""].decoded == ""
    assert rows["a b"].ids == LIBRARY.encode("a b")
    assert all(r.decoded == (r.text or "") for r in rows.values())
    again = found.select("text", decode(docs.sparkSession, default_model())("ids").alias("again")).collect()
    assert all(r.again == (r.text or "") for r in again)
    assert with_pieces(make_docs([]), default_model()).count() == 0
