import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from matchlake.llm import byte_bpe
from matchlake.llm.byte_bpe import ByteBpe, decoder, merged, op11_byte_bpe, with_byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(ranks):
    known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=known, special_tokens={})


def unpacked(packed):
    return np.frombuffer(packed, "<u4").tolist()


ALPHABETS = ["ab", "aab ", "abc'sllre \n\t 12!", "éß日本語 aé", "a", "　 \n\r\x0b'd", "🙂a ", "it's I'll we've\xa0\x85 "]


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize(("chars", "n_bytes"), [(1, 1), (2, 3), (7, 16), (50, 32)])
def test_trees_of_any_leaf_give_the_ids_of_the_library(monkeypatch, ranks, library, alphabet, chars, n_bytes):
    monkeypatch.setattr(byte_bpe, "LEAF_CHARS", chars)
    monkeypatch.setattr(byte_bpe, "LEAF_BYTES", n_bytes)
    monkeypatch.setattr(byte_bpe, "LEAF_IDS", 2)
    monkeypatch.setattr(byte_bpe, "KEPT_WORDS", 3)
    monkeypatch.setattr(byte_bpe, "KEPT_PAIRS", 3)
    model, draw = ByteBpe(ranks, PATTERN), random.Random(chars)
    for _ in range(40):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 200)))
        ids = model.encode(text)
        assert unpacked(ids) == library.encode_ordinary(text)
        assert model.decode(ids) == text.encode()


def test_both_ways_of_merging_agree(ranks):
    model, draw = ByteBpe(ranks, PATTERN), random.Random(4)
    for n in (0, 1, 2, 3, 10, 60, 64):
        for _ in range(30):
            data = bytes(draw.choice(b"aabtheingr\xc3\xa9") for _ in range(n))
            assert byte_bpe._merged_short(data, model.ranks) == byte_bpe._merged_long(data, model.ranks)
    assert merged(b"", model.ranks) == []


def test_neighbours_join_to_the_whole(ranks):
    model, draw = ByteBpe(ranks, PATTERN), random.Random(5)
    for _ in range(100):
        data = bytes(draw.choice(b"aabetionsr") for _ in range(draw.randint(2, 90)))
        cut = draw.randrange(1, len(data))
        assert model.join(merged(data[:cut], model.ranks), merged(data[cut:], model.ranks)) == merged(data, model.ranks)


def test_query_equals_the_library(spark, sf_dir, sf_texts, library):
    from hashlib import sha256

    expected = {}
    for i, text in sf_texts.items():
        ids = library.encode_ordinary(text or "")
        digests = sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256((text or "").encode()).hexdigest()
        expected[i] = (len(ids), *digests)
    rows = op11_byte_bpe(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == expected


def test_odd_rows(make_docs, library):
    unbroken = "".join(random.Random(6).choice("abcdefgh") for _ in range(200_000))
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (4, "words " * 100_000), (5, unbroken), (6, "a" * 20_000)]
    docs = make_docs(rows)
    found = with_byte_bpe(docs, PATH, PATTERN)
    assert found.columns == [c for c in docs.columns if c != "ids"] + ["ids", "n_tokens", "decoded"]
    key = lambda x: (x[0] or 0, x[1])
    assert sorted(((r.doc_id, unpacked(r.ids)) for r in found.collect()), key=key) == sorted(
        ((i, library.encode_ordinary(text or "")) for i, text in rows), key=key
    )
    assert all(r.n_tokens * 4 == len(r.ids) and r.decoded.decode() == (r.text or "") for r in found.collect())
    assert with_byte_bpe(make_docs([]), PATH, PATTERN).count() == 0


def test_decoding_alone(spark, library):
    packed = [np.array(library.encode_ordinary(text), "<u4").tobytes() for text in ("", "some words", "é日")]
    df = spark.createDataFrame([(x,) for x in [*packed, None]], "ids binary")
    rows = df.select(decoder(spark, PATH, PATTERN)(F.col("ids")).alias("x")).collect()
    assert [None if r.x is None else r.x.decode() for r in rows] == ["", "some words", "é日", None]
    with pytest.raises(PythonException):
        spark.createDataFrame([(b"\xff\xff\xff\xff",)], "ids binary").select(decoder(spark, PATH, PATTERN)(F.col("ids"))).collect()


def test_vocabularies_without_a_byte_are_refused():
    with pytest.raises(ValueError):
        ByteBpe(b"YQ== 0\n", PATTERN)
