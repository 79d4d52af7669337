import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from loomline.llm import counting, driver_queries, packing, records, tokens
from loomline.llm.tokens import BatchEncoder, load_tokenizer
from tests.llm import docs as D

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "B", "'s", "'", "9", ".", " ", "\n", "\t", "\x1c", "\x85", "é", "É", "ß", "×", "ª", "Σ", "İ", "é", "日", "<|endoftext|>", "<|", "word", "The", ","]


def direct(path, texts):
    return [e.ids for e in load_tokenizer(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), max_size=12).map("".join), max_size=6))
def test_batch_encoder_gives_the_ids_of_the_library(texts):
    ids, at = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == direct(WORD, texts)


ENCODER = BatchEncoder(WORD)


def test_encoder_takes_the_direct_way_for_other_tokenizers():
    ids, at = BatchEncoder(BYTE).encode(pa.array(["a  b", None, "c\n"]))
    assert [ids[at[i] : at[i + 1]].tolist() for i in range(3)] == direct(BYTE, ["a  b", "", "c\n"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*ODD, " x", "  ", "don't", "\n\n", "abc"]), max_size=80).map("".join), st.integers(3, 20), st.integers(1, 6))
def test_chunks_are_spliced_to_the_ids_of_the_whole(text, chunk, overlap):
    t = load_tokenizer(BYTE)

    def encode(part):
        e = t.encode(part, add_special_tokens=False)
        return e.ids, e.offsets

    if "<|" not in text:  # a special string may be cut only by a chunk border; below, with room for it
        assert counting.chunked_ids(encode, text, chunk, overlap) == encode(text)[0]
    assert counting.chunked_ids(encode, text, chunk + 30, overlap + 20) == encode(text)[0]


def test_a_text_without_blanks_widens_to_the_whole():
    t = load_tokenizer(BYTE)
    text = "abcdefgh" * 3000
    e = t.encode(text, add_special_tokens=False)
    assert counting.chunked_ids(lambda s: (lambda x: (x.ids, x.offsets))(t.encode(s, add_special_tokens=False)), text, 500, 10) == e.ids


def test_count_tokens(spark):
    got = counting.count_tokens(D.make(spark), BYTE, chunk=5000, overlap=64).collect()
    want = sorted(((r[0], len(ids), len((r[1] or "").encode())) for r, ids in zip(D.ROWS, direct(BYTE, [r[1] for r in D.ROWS]), strict=True)), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.n_bytes) for r in got), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert counting.count_tokens(D.empty(spark), BYTE).count() == 0


def test_records_round_trip(spark):
    path, index = records.encode_to_records(D.make(spark), WORD, end_id=1)
    rows = sorted(D.ROWS, key=lambda r: (r[0] is not None, r[0] or 0))
    want, start = [], 0
    for r, ids in zip(rows, direct(WORD, [r[1] for r in rows]), strict=True):
        ids = np.array([*ids, 1], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in index.orderBy("start").collect()]
    assert got == want
    back = records.read_shuffled(spark, path, index.where("n_tokens > 1"), seed=3).collect()
    assert sorted(zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in back) == sorted(w[3] for w in want if w[2] > 1)
    assert records.encode_to_records(D.empty(spark), WORD)[1].count() == 0


def test_an_id_of_many_rows_is_dealt_among_files_and_files_are_numbered(spark, monkeypatch):
    monkeypatch.setattr(records, "FILE_BYTES", 40)
    rows = [(7, "the same row again", None, None, None)] * 300 + [(None, f"no id {i % 3}", None, None, None) for i in range(60)] + [(i, f"row {i}", None, None, None) for i in range(-20, 120) if i != 7]
    docs = D.make(spark, rows).repartition(5)
    path, index = records.encode_to_records(docs, WORD)
    got = index.orderBy("start").collect()
    key = lambda r: (r.doc_id is not None, r.doc_id or 0)
    assert [key(r) for r in got] == sorted(map(key, got)) and len(got) == len(rows)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert len({r.file for r in got if r.doc_id == 7}) > 20
    renamed = [f"part-{n:05d}-x-c000.txt" for n in (99_999, 100_000, 2)]
    odd = [(f, 0, n, 0, 30, 0, 5, 0) for n, f in enumerate(renamed)]
    spark.createDataFrame(odd, records.INDEX_SCHEMA).createOrReplaceTempView("odd_index")
    monkeypatch.setattr(records, "read_index", lambda *_: spark.table("odd_index"))
    placed = records.write_index(spark, path, f"{path}-odd").orderBy("start").collect()
    assert [r.doc_id for r in placed] == [2, 0, 1]


def test_parts_of_keys():
    bounds = np.array([3, 5, 5, 5, 9])
    got = records.part_of(np.array([1, 3, 4, 5, 5, 5, 5, 6, 9, 10]), bounds, 0)
    assert got.tolist() == [0, 0, 1, 4, 1, 2, 3, 4, 4, 5] and records.part_of(np.array([4, 7]), np.zeros(0, np.int64), 3).tolist() == [0, 0]


def test_files_are_bounded_by_bytes(spark):
    """Long documents at the end of the order, one longer than a file, and an id with a third of all rows."""
    size = 100_000
    rows = [(i, "w " * 50) for i in range(900)] + [(900 + i, "long " * 20_000) for i in range(10)] + [(950, "huge " * 80_000), (None, "x")] + [(400, "same " * 100)] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _, index = records.encode_to_records(docs, WORD, file_bytes=size)
    text_bytes = {d: len(t) for d, t in rows}
    files = defaultdict(list)
    for r in index.collect():
        files[r.file].append(text_bytes[r.doc_id])
    assert sum(map(len, files.values())) == len(rows)
    assert max(sum(x) - max(x) for x in files.values()) <= 1.2 * size
    order = [r.doc_id for r in index.orderBy("start").collect()]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))


@given(st.binary(max_size=60), st.integers(0, 200))
@settings(deadline=None)
def test_a_changed_byte_is_noticed(payload, where):
    data = records.frame(payload)
    assert [p for _, _, p in records.frames(data + data)] == [payload, payload]
    broken = bytearray(data)
    broken[where % len(data)] ^= 1
    with pytest.raises(ValueError):
        list(records.frames(bytes(broken)))


@given(st.lists(st.integers(1, 20_000), max_size=6), st.sampled_from([1, 2, 64, 4096]))
def test_piece_lengths(sizes, longest):
    lengths, counts = packing.piece_lengths(np.array(sizes, np.int64), longest)
    at = 0
    for size, n in zip(sizes, counts, strict=True):
        own = lengths[at : at + n].tolist()
        at += n
        assert sum(own) == size and all(x & (x - 1) == 0 and x <= longest for x in own)
        short = [x for x in own if x < longest]
        assert len(set(short)) == len(short) and own == sorted(own, reverse=True)
    assert at == len(lengths)


def test_packing_holds_every_token_once(spark):
    got = packing.pack(D.make(spark), WORD, end_id=2, longest=4096).collect()
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    by_length = [r.length for r in sorted(got, key=lambda r: r.sequence_id)]
    assert by_length == sorted(by_length, reverse=True)
    pieces = defaultdict(list)
    for r in got:
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and zlib.crc32(r.ids) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length, bytes(r.ids), r.doc_tokens))
    for doc_id, ids in ((r[0], x) for r, x in zip(D.ROWS, direct(WORD, [r[1] for r in D.ROWS]), strict=True)):
        if doc_id != 5:
            parts = sorted(pieces[doc_id])
            assert b"".join(p[2] for p in parts) == np.array([*ids, 2], "<u4").tobytes()
            assert [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
            assert {p[3] for p in parts} == {len(ids) + 1}
    again = packing.pack(D.make(spark), WORD, end_id=2, keep_ids=False).collect()
    assert sorted((r.sequence_id, str(r.doc_id), r.start, r.ids_crc32) for r in again) == sorted((r.sequence_id, str(r.doc_id), r.start, r.ids_crc32) for r in got)
    assert packing.pack(D.empty(spark), WORD).count() == 0


def test_registered_packing_writes_its_ids(spark, tmp_path):
    D.make(spark, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    packed = driver_queries.op5_power_of_two_packing(spark, str(tmp_path))
    staged = corpus_pipeline.pack_sequences(spark, D.make(spark), str(tmp_path))
    for got in (packed.collect(), staged.collect()):
        whole = defaultdict(list)
        for r in sorted(got, key=lambda r: (str(r.doc_id), r.start, r.sequence_id)):
            assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
            whole[r.doc_id].append(bytes(r.ids))
        assert sorted(r.sequence_id for r in got) == list(range(len(got)))
        for (doc_id, *_), ids in zip(D.ROWS, direct(WORD, [r[1] for r in D.ROWS]), strict=True):
            if doc_id == 5:
                assert len(b"".join(whole[5])) == 2 * 4 * (len(ids) + 1)
            else:
                assert b"".join(whole[doc_id]) == np.array([*ids, 2], "<u4").tobytes()


def test_small_memos_give_the_same_ids(monkeypatch):
    """Words and pieces that are forgotten, kept or learned anew have the ids that the library gives."""
    monkeypatch.setattr(tokens, "MEMO_WORDS", 60)
    monkeypatch.setattr(tokens, "MEMO_PIECES", 20)
    enc = BatchEncoder(WORD)
    draw = random.Random(3)
    stock = ["the", "The", "tree.", "garden,", "it's", "können", "ÉTÉ!!", "x7y", "日本", ""]
    for _ in range(40):
        made = ["".join(draw.choice("abcdeüß.1'") for _ in range(draw.randint(1, 6))) for _ in range(15)]
        texts = [" ".join(draw.choice(stock + made) for _ in range(draw.randint(0, 12))) for _ in range(8)]
        ids, at = enc.encode(pa.array(texts))
        assert [ids[at[i] : at[i + 1]].tolist() for i in range(len(texts))] == direct(WORD, texts)
