"""Files of directly addressable token ids: format, encoder, and the whole way on Spark."""

import io
import zlib

import numpy as np
import pytest

from vanewright.llm import queries, tokenfiles

FOLDER = "/root/testdata/sf0.001"
PATH = queries.tokenizer_path("word_bpe_49k.json")


def opened(doc_ids, lengths, ids):
    return tokenfiles.TokenFile(io.BytesIO(tokenfiles.file_bytes(doc_ids, lengths, np.array(ids, np.uint32))))


@pytest.mark.parametrize("largest", [1, 255, 256, 49_408, 2**24, 2**32 - 1])
@pytest.mark.parametrize("size", [1, 7, 8, 511, 512, 513, 1024, 3000])
def test_every_token_is_read_by_its_number(largest, size):
    rng = np.random.default_rng(size)
    ids = np.where(rng.random(size) < 0.5, rng.integers(0, largest, size, endpoint=True), rng.integers(0, 2, size))
    file = opened([5], [size], ids)
    assert file.tokens == size
    assert [file.token(i) for i in range(size)] == ids.tolist()
    for first, last in [(0, size), (0, 0), (size, size), (size // 2, size), (1, size - 1), *np.sort(rng.integers(0, size, (20, 2)))]:
        assert file.slice(first, last).tolist() == ids[first:max(first, last)].tolist()
    with pytest.raises(IndexError):
        file.token(size)


def test_all_ids_large_or_small():
    for ids in ([2**32 - 1] * 1024, [0] * 1024, [256] * 512 + [3], [3] * 512 + [256] * 512):
        file = opened([1], [len(ids)], ids)
        assert [file.token(i) for i in range(len(ids))] == ids == file.slice(0, len(ids)).tolist()


def test_few_bytes_are_read_for_a_token():
    class Counted(io.BytesIO):
        read_bytes = 0

        def read(self, size=-1):
            self.read_bytes += size
            return super().read(size)

    ids = np.random.default_rng(1).integers(0, 50_000, 200_000).astype(np.uint32)
    source = Counted(tokenfiles.file_bytes([1], [len(ids)], ids))
    file = tokenfiles.TokenFile(source)
    source.read_bytes = 0
    assert file.token(150_000) == ids[150_000]
    assert source.read_bytes < 100


def test_documents_of_a_file():
    file = opened([None, 3, 3, -7], [2, 0, 1, 4], [1, 2, 3, 4, 5, 6, 700])
    assert file.table(0, 4)[0] == [None, 3, 3, -7] and file.table(0, 4)[1].tolist() == [0, 2, 2, 3, 7]
    assert file.table(2, 3)[0] == [3] and file.table(2, 3)[1].tolist() == [2, 3]
    empty = opened([], [], [])
    assert empty.tokens == empty.documents == 0 and empty.slice(0, 0).tolist() == []
    with pytest.raises(ValueError):
        tokenfiles.TokenFile(io.BytesIO(b"x" * 100))


ODD = [
    "It's THE'LL don't 'S x's 've'", "İstanbul ŒUVRE ŉ ſ ĸ ß ǅ", "é café ́x", "Σ ΑΣ σς", "", " \n\t", "日本語 😀x",
    "a<|endoftext|>b  <|startoftext|>", "a b\x85c\x1cd e", "12345 6.7%$ --- ½² Ⅷ", "x" * 5000, "a\x00b \x7f", "ééé!!!",
]


@pytest.mark.parametrize("text", ODD)
def test_encoder_on_odd_texts(text):
    encoder = tokenfiles.WordEndEncoder(PATH)
    assert encoder.by_word and encoder.ranks
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_on_documents(spark, monkeypatch):
    encoder = tokenfiles.WordEndEncoder(PATH)
    monkeypatch.setattr(tokenfiles, "CACHE_WORDS", 100)
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        assert np.frombuffer(encoder.encode(r.text.encode()), "<u4").tolist() == encoder.tokenizer.encode(r.text, add_special_tokens=False).ids


def test_files_that_are_not_cut_at_white_space_go_through_the_library():
    encoder = tokenfiles.WordEndEncoder(queries.tokenizer_path("byte_bpe_50k.json"))
    assert not encoder.by_word
    text = "two  words\n and more"
    assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_query_against_the_library(spark):
    library = tokenfiles.encoder(PATH).tokenizer
    start, expected = 0, []
    for r in sorted(spark.read.parquet(f"{FOLDER}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [1]
        expected.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = queries.op12_token_files(spark, FOLDER)
    assert dict(found.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_odd_rows_small_files_and_random_places(spark, odd_docs, no_docs, folder, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FILE_TOKENS", 20)
    monkeypatch.setattr(tokenfiles, "READ_TOKENS", 10)
    monkeypatch.setattr(tokenfiles, "_KEY", 16)
    library = tokenfiles.encoder(PATH).tokenizer
    files = tokenfiles.write_tokens(odd_docs.repartition(3), f"{folder}/out", PATH, end=1).collect()
    assert len(files) > 8 and sum(f.documents for f in files) == odd_docs.count()
    rows = sorted(tokenfiles.read_documents(spark, f"{folder}/out").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in odd_docs.collect()), key=lambda i: (i is not None, i))
    whole = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows])
    assert [r.start for r in rows] == np.r_[0, np.cumsum([r.n_tokens for r in rows])[:-1]].tolist()
    texts = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [1] for r in odd_docs.collect()}
    assert all(np.frombuffer(r.ids, "<u4").tolist() == texts[r.doc_id] for r in rows)
    places = [*range(len(whole)), 3, 3, None, -1, len(whole), 10**12]
    asked = spark.createDataFrame([(p, "kept") for p in places], "position long, _file string")
    found = tokenfiles.tokens_at(asked, f"{folder}/out")
    assert found.columns == ["position", "_file", "token"] and found.count() == len(places)
    for r in found.collect():
        inside = r.position is not None and 0 <= r.position < len(whole)
        assert r.token == (whole[r.position] if inside else None)
    assert tokenfiles.write_tokens(no_docs, f"{folder}/none", PATH, end=1).count() == 0
    assert tokenfiles.read_documents(spark, f"{folder}/none").count() == 0


def test_one_doc_id_for_most_rows_is_dealt_to_many_tasks(spark, folder, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these tables are too small for parts
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    docs = spark.range(4000).selectExpr("if(id % 3 < 2, 7, id) AS doc_id", "concat('text ', id) AS text")
    files = tokenfiles.write_tokens(docs, f"{folder}/out", PATH, end=1)
    assert files.groupBy("part").sum("documents").count() > 1
    assert tokenfiles.read_documents(spark, f"{folder}/out").count() == 4000
