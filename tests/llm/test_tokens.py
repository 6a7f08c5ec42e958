"""BPE and id files against the tokenizers library, over odd texts and a whole small table."""

import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gridtables.llm import bpe, dac
from gridtables.llm.queries import op3, op10, tokenizer
from gridtables.llm.common import shared_folder

FOLDER = "/root/testdata/sf0.001"
PIECES = [
    "a", "aa", " ", "  ", "\n", "\t", "é", "ß", "日", "1", "22", "'s", "'", "!", "!!", "<|endoftext|>", "<|endof", " ", "　",
    "\x1c", "\x85", "the", "ing", "😀", "\r\n", "_", "---", "A", "Z", "zz", "​", "՘", ",", ".", "\x00",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer())


def texts():
    pick = random.Random(7)
    return [
        None, "", " ", "  ", "x", *("".join(pick.choices(PIECES, k=pick.randint(1, 50))) for _ in range(400)),
        "a" * 3000, "ab" * 2000, " " * 300, "-" * 2500, "word " * 3000,
    ]


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_odd_texts_encode_and_decode(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = {r.doc_id: r for r in bpe.encode_digests(df, tokenizer()).collect()}
    assert len(got) == len(rows)
    for i, text, _ in rows:
        ids, back = expected(library, text)
        assert got[i].n_tokens == len(ids), repr(text)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), repr(text)
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest(), repr(text)


def test_encode_column_keeps_columns_and_refuses_a_clash(spark, library):
    df = spark.createDataFrame([(1, "one two", 5), (None, None, 6), (1, "one two", 5)], "doc_id long, text string, extra int")
    got = bpe.encode_column(df, tokenizer(), decoded_col="back").collect()
    assert [(r.doc_id, r.extra, r.back) for r in got] == [(1, 5, "one two"), (None, 6, ""), (1, 5, "one two")]
    assert np.frombuffer(got[0].ids, "<u4").tolist() == library.encode("one two").ids
    with pytest.raises(ValueError):
        bpe.encode_column(df.withColumn("ids", df.extra), tokenizer())


def test_every_token_is_its_own_encoding_or_marked():
    with open(tokenizer(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    trie = bpe.Trie(vocabulary)
    pick = random.Random(3).sample(sorted(vocabulary.ids), 2000)
    for text, ids in trie.encode(pick).items():
        assert np.frombuffer(ids, "<u4").tolist() == vocabulary.merge(text)


def test_query_encodes_whole_table(spark, library):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op3(spark, FOLDER).collect()}
    for doc_id, text in rows:
        ids, back = expected(library, text)
        assert (got[doc_id].n_tokens, got[doc_id].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[doc_id].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def check_files(rows, got, library):
    start = 0
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = [*expected(library, text)[0], 2]
        raw = np.array(ids, "<u4").tobytes()
        assert tuple(got[doc_id])[1:] == (start, len(ids), zlib.crc32(raw))
        start += len(ids)


def test_query_reads_back_what_it_wrote(spark, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in op10(spark, FOLDER).select("doc_id", "start", "n_tokens", "ids_crc32").collect()}
    assert len(got) == len(rows)
    check_files(rows, got, library)


def test_many_segments_null_and_repeated_ids(spark, library, monkeypatch):
    monkeypatch.setattr(dac, "SEGMENT", 500)
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows] + [(None, "null id", "z"), (None, None, "z")], "doc_id long, text string, start string")
    folder = shared_folder(spark)
    dac.write_ids(df, tokenizer(), folder, tasks=3)
    found = dac.read_documents(spark, folder).collect()
    assert len(found) == len(rows) + 2
    nulls = [r for r in found if r.doc_id is None]
    assert sorted(r.n_tokens for r in nulls) == [1, 1 + len(library.encode("null id").ids)] and all(r.partition == 0 for r in nulls)
    for r in found:
        if r.doc_id is not None:
            raw = np.array([*expected(library, dict(rows)[r.doc_id])[0], 2], "<u4").tobytes()
            assert (r.n_tokens, r.ids_crc32) == (len(raw) // 4, zlib.crc32(raw))
    twice = df.unionByName(df)
    again = dac.stored(twice, tokenizer()).collect()
    assert len(again) == 2 * len(found)
    places = sorted((r.start, r.n_tokens) for r in again)
    assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False))
    wanted = spark.createDataFrame([(r.partition, r.at) for r in found], "partition long, at long")
    ids = {(r.partition, r.at): r.id for r in dac.read_tokens(spark, folder, wanted).collect()}
    for r in found:
        first = [*expected(library, "null id" if r.doc_id is None else dict(rows)[r.doc_id])[0], 2][0]
        assert r.doc_id is None or ids[r.partition, r.at] == first


def test_random_access_over_all_widths():
    ids = np.random.default_rng(1).integers(0, 2**32, 5000, dtype=np.uint32) >> np.random.default_rng(2).integers(0, 32, 5000).astype(np.uint32)
    own = dac.Segment(dac.segment(np.array([4]), np.array([False]), np.array([5000]), ids, 0, 0))
    assert own.ids().tolist() == ids.tolist()
    assert [own[i] for i in range(0, 5000, 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        own[5000]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode_digests(empty, tokenizer()).count() == 0
    assert dac.stored(empty, tokenizer()).count() == 0


def test_a_writing_task_holds_little_beside_its_text(spark):
    # most that the encoder holds at a time, in bytes a byte of text; what is encoded together is bounded by bytes, in whole small batches
    with open(tokenizer(), encoding="utf-8") as file:
        encoder = bpe.library_encoder(file.read())
    pick = random.Random(5)
    known = ["".join(pick.choices("abcdefghij", k=pick.randint(2, 8))) for _ in range(5000)]
    texts = pa.array([" ".join(pick.choices(known, k=400)) for _ in range(2000)], pa.large_string())
    encoder.batch(texts)
    tracemalloc.start()
    try:
        encoder.batch(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 7 * texts.nbytes
    batches = [pa.RecordBatch.from_arrays([texts.slice(i, 100)], names=["body"]) for i in range(0, 2000, 100)]
    runs = list(bpe.gathered(iter(batches), "body", 1 << 20))
    assert len(runs) > 1 and all(1 << 20 <= r.nbytes < (1 << 20) + 2 * batches[0].nbytes for r in runs[:-1])
    assert pa.chunked_array([r["body"] for r in runs]).combine_chunks().equals(texts)
    dac.stored(spark.createDataFrame([(1, "a")], "doc_id long, text string"), tokenizer()).collect()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000


def test_a_full_cache_keeps_the_words_at_hand(library):
    calls = []
    own = bpe.UnitEncoder(lambda words: calls.append(len(words)) or [bytes(4 * len(w)) for w in words], str.split, {}, 4)
    assert [len(x) for x in own._packed(["a", "bb", "ccc"])] == [4, 8, 12]
    assert [len(x) for x in own._packed(["bb", "dddd", "eeeee"])] == [8, 16, 20]
    assert calls == [3, 2] and sorted(own.known) == ["bb", "dddd", "eeeee"]
