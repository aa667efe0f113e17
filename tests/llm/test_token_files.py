import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from matchlake.llm import token_files
from matchlake.llm.token_files import WholeEncoder, WordEncoder, encoder_of, op9_token_files, read_token_files, with_starts, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "\n\n", "<|endoftext|> a<|startoftext|>b", "it's I'll x'yz 'S", "á ́b e\r\nf\x0bg\x1ch i　j",
    "ǅ İstanbul ﬁ 12 3.4", "日本 語", "x" * 5000, "🙂🙂",
    "ÉCOLE! École, École. Straße* STRASSE ÿ× ÷ª å", "a. a.b a..b) x), don't, U.S. e̊, ŒUVRE ﬀ K",
]


def library_ids(texts):
    encoded = Tokenizer.from_file(PATH).encode_batch([text or "" for text in texts], add_special_tokens=False)
    return [[*x.ids, 1] for x in encoded]


def expected_rows(texts):
    """texts: in order. (start, n_tokens, crc32) of each."""
    rows, start = [], 0
    for ids in library_ids(texts):
        rows.append((start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_words_encode_as_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 5)
    encoder = encoder_of(Path(PATH).read_bytes())
    assert isinstance(encoder, WordEncoder)
    assert [np.frombuffer(x, "<u4").tolist() for text in ODD for x in encoder.ids([text], 1)] == library_ids(ODD)


def test_query_equals_the_library(spark, sf_dir, sf_texts):
    rows = sorted(op9_token_files(spark, sf_dir).collect())
    assert [r.doc_id for r in rows] == list(sf_texts)
    assert [(r.start, r.n_tokens, r.ids_crc32) for r in rows] == expected_rows(sf_texts.values())


def test_odd_rows_are_written_in_order(spark, make_docs, tmp_path):
    rows = [(20 + i, text) for i, text in enumerate(ODD)] + [(5, None), (5, None), (None, "no id"), (30, "last " * 50_000)]
    path = str(tmp_path / "files")
    write_token_files(make_docs(rows[::-1]), path, PATH)
    found = with_starts(read_token_files(spark, path)).orderBy("row_id").collect()
    order = [(None, "no id"), (5, None), (5, None), *((20 + i, text) for i, text in enumerate(ODD)), (30, "last " * 50_000)]
    order.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r.doc_id for r in found] == [i for i, _ in order]
    ids_20_and_30 = [r.ids for r in found if r.doc_id == 21]
    assert ids_20_and_30 == [library_ids([" "])[0]]
    assert [(r.start, r.n_tokens) for r in found][:3] == [(0, 3), (3, 1), (4, 1)]
    assert found[-1].start == sum(r.n_tokens for r in found[:-1])


def test_empty_table(spark, make_docs, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(make_docs([]), path, PATH)
    assert with_starts(read_token_files(spark, path)).count() == 0


def test_ids_are_looked_up_by_metadata(spark, make_docs, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(make_docs([(2 * i, f"text {i}") for i in range(500)]), path, PATH)
    rows = read_token_files(spark, path, [10, 11, 998])
    assert sorted(r.doc_id for r in rows.collect()) == [10, 998]
    assert "PushedFilters: [In(doc_id" in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n_ids", [1, 70_000])
def test_crc_is_of_little_endian_words(spark, n_ids):
    df = spark.range(1).select(F.sequence(F.lit(1), F.lit(n_ids)).cast("array<int>").alias("ids"))
    row = df.select(token_files.ids_crc32("ids").alias("crc")).first()
    assert row.crc == zlib.crc32(np.arange(1, n_ids + 1, dtype="<u4").tobytes())


def test_other_vocabularies_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, texts = encoder_of(Path(path).read_bytes()), ["Hello World", *ODD]
    assert isinstance(encoder, WholeEncoder)
    expected = [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist()[:-1] for x in encoder.ids(texts, 1)] == expected


def test_the_encoder_is_built_once_a_worker(spark, make_docs, monkeypatch):
    built = []
    monkeypatch.setattr(token_files, "encoder_of", lambda data: built.append(1) or WordEncoder(data))
    token_files._encoders.clear()
    import pyarrow as pa

    encode = token_files.encode(spark, PATH, 1).func
    for _ in range(3):
        assert [x.to_pylist() for x in encode(iter([pa.array(["a"])]))] == [[library_ids(["a"])[0]]]
    assert len(built) == 1
    token_files._encoders.clear()
