"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

File format. A file is a run of frames; all numbers are little-endian::

    uint64  length of the payload
    uint32  masked CRC-32 of those 8 bytes
    bytes   payload
    uint32  masked CRC-32 of the payload
    byte    0x0A, the frame's end mark

A payload is ``uint8 flags, int64 doc_id, ids``: bit 0 of the flags says that doc_id is
null, bit 1 that ids are uint32 rather than uint16. The mask rotates the CRC right by 15
bits and adds a constant, so that a checksum over stored checksums stays meaningful.

Files come from Spark's own text writer (the end mark is its line separator), so a file
appears only when its task commits, a lost executor's task is simply run again, and any
file system that Spark knows will do. Files follow each other in ascending doc_id order, by the
number in their names.

Texts are encoded where they are read, and only frames are dealt out and sorted. Files are
cut by running sums of bytes, so that each holds the frames of FILE_BYTES of text and those
of one more document at most, wherever long documents stand.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.llm.common import cut, scratch, setting
from loomline.llm.tokens import encoder, release, slices

MASK_DELTA = 0xA282EAD8
HEAD, TAIL, LEAD = struct.Struct("<QI"), struct.Struct("<I"), struct.Struct("<Bq")
END = b"\n"
#: Bytes of text whose frames make a file, but for its last document; ids take about half of that. A file is read as a whole.
FILE_BYTES = 32 << 20
#: Words that the encoder keeps, and bytes of text encoded at a time: less than elsewhere, as the frames of a batch are held too.
MEMO_WORDS, SLICE_BYTES = 450_000, 6_000_000
#: Bytes of text in a batch that Spark hands to Python at most; it is held several times over on the way.
BATCH_BYTES = 12_000_000
#: What a frame has besides its ids.
FRAME_BYTES = HEAD.size + LEAD.size + TAIL.size + len(END)
#: Where null ids stand in the order.
NO_ID = -(1 << 63)
INDEX_SCHEMA = "file string, row long, doc_id long, position long, length long, start_in_file long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    """CRC-32, rotated right by 15 bits, plus a constant, modulo 2**32."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return length + TAIL.pack(masked(length)) + payload + TAIL.pack(masked(payload)) + END


def payload_of(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    return LEAD.pack((doc_id is None) | wide << 1, doc_id or 0) + ids.astype("<u4" if wide else "<u2").tobytes()


def parse_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = LEAD.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & 2 else "<u2", offset=LEAD.size)
    return None if flags & 1 else doc_id, ids


def frames(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(position, frame length, payload) of each frame; raises ValueError where a checksum or mark is wrong."""
    at = 0
    while at < len(data):
        yield at, *(read := read_frame(data, at))
        at += read[0]


def read_frame(data: bytes, at: int = 0) -> tuple[int, bytes]:
    """(frame length, payload) of the frame that begins at a position."""
    if len(data) < at + HEAD.size:
        raise ValueError(f"cut-off frame at byte {at}")
    size, check = HEAD.unpack_from(data, at)
    if masked(data[at : at + 8]) != check:
        raise ValueError(f"wrong length checksum at byte {at}")
    begin, end = at + HEAD.size, at + HEAD.size + size
    payload = data[begin:end]
    if len(data) < end + TAIL.size + len(END) or TAIL.unpack_from(data, end)[0] != masked(payload) or data[end + TAIL.size : end + TAIL.size + 1] != END:
        raise ValueError(f"wrong payload checksum at byte {at}")
    return HEAD.size + size + TAIL.size + len(END), payload


def file_bounds(docs: DataFrame, file_bytes: int) -> list[int]:
    """Ids that end a file: each file is of ``file_bytes`` of text, or less so that every shuffle partition has one, and of its last document's.

    Ids and sizes alone are put in order, in ranges; the ranges' sums, one a partition, come to
    the driver, and then each range tells at which ids the running sum passes the end of a file. An id
    that passes several ends is given for each. One number a file is all that is kept.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + FRAME_BYTES).cast("long").alias("n"))
    # An id that many rows have is one row here; the checkpoint fixes what is in which range.
    ranges = cut(cut(ids.groupBy("id").agg(F.sum("n").alias("n"))).repartitionByRange("id").sortWithinPartitions("id"))

    def sums(batches):
        total = sum(int(b.column("n").to_numpy().sum()) for b in batches)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total], pa.int64())], ["part", "n"])

    found = sorted(map(tuple, ranges.mapInArrow(sums, "part long, n long").collect()))
    total = sum(n for _, n in found)
    size = max(1, min(file_bytes, -(-total // int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))
    before = dict(zip([p for p, _ in found], np.cumsum([0] + [n for _, n in found])[:-1].tolist(), strict=True))

    def ends(batches):
        at = before[TaskContext.get().partitionId()]
        for batch in batches:
            after = at + np.cumsum(batch.column("n").to_numpy())
            passed = np.diff(after // size, prepend=at // size)
            at = int(after[-1]) if len(after) else at
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("id").to_numpy(), passed))], ["id"])

    return sorted(r["id"] for r in ranges.mapInArrow(ends, "id long").collect())


def part_of(keys: np.ndarray, bounds: np.ndarray, turn: int) -> np.ndarray:
    """The part of each key. A key that is several bounds at once fills more than a part; its rows take turns among those."""
    low, high = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
    return low + np.where(high - low > 1, (turn + np.arange(len(keys))) % (high - low + 1), 0)


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, file_bytes: int | None = None) -> None:
    """Encode every whole text, append ``end_id``, and write frames in ascending doc_id order.

    Null ids come first. Rows of one id stand in the order of their frames, or, if they
    fill several files, of their input partitions too. A null or empty text gives the end id
    alone. Columns other than doc_id and text are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    bounds = file_bounds(rows, file_bytes or FILE_BYTES)
    shared = docs.sparkSession.sparkContext.broadcast(np.array(bounds, np.int64))

    def encode(batches):
        enc, tail = encoder(tokenizer_path, MEMO_WORDS), np.array([end_id], np.uint32)
        turn = TaskContext.get().partitionId()
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            parts = part_of(np.array([NO_ID if d is None else d for d in doc_ids], np.int64), shared.value, turn)
            turn += len(parts)
            for a, b in slices(texts, SLICE_BYTES):
                ids, at = enc.encode(texts[a:b])
                made = [frame(payload_of(doc_ids[a + i], np.concatenate([ids[at[i] : at[i + 1]], tail])))[: -len(END)] for i in range(b - a)]
                yield pa.RecordBatch.from_arrays([pa.array(parts[a:b].astype(np.int32)), batch.column("doc_id")[a:b], pa.array(made, pa.binary())], ["part", "doc_id", "frame"])
                del ids, at, made
            del batch, texts
        release()

    framed = rows.mapInArrow(encode, "part int, doc_id long, frame binary")
    dealt = framed.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "frame")
    # A cast of binary to string keeps the bytes, and the text writer writes them as they are.
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        dealt.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", END.decode()).text(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per frame of the files at ``path``, with its place; checks every checksum."""

    def scan(batches):
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                out, start = [], 0
                for row, (position, length, payload) in enumerate(frames(memoryview(data.as_buffer()))):
                    doc_id, ids = parse_payload(payload)
                    out.append((name.rsplit("/", 1)[-1], row, doc_id, position, length, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                if out:
                    names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
                    kinds = [pa.string()] + [pa.int64()] * 7
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
            batch = data = None
        release()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(scan, INDEX_SCHEMA)


def write_index(spark: SparkSession, path: str, index_path: str) -> DataFrame:
    """Write the offset index beside the records, and return it with each frame's global token start."""
    read_index(spark, path).write.parquet(index_path)
    index = spark.read.parquet(index_path)
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    # One row per file.
    placed = index.join(F.broadcast(bases), "file")
    return placed.withColumn("start", F.col("_base") + F.col("start_in_file")).drop("_base")


def read_shuffled(spark: SparkSession, path: str, index: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, ids) of the frames that an index lists, in an order that the seed decides.

    Each file is opened once; its frames are cut out by the index's positions and then
    dealt out by a hash, so neighbours in a file part ways. Frames the index lacks stay unread.
    """

    def cut_out(batches):
        for batch in batches:
            for data, spots in zip(batch.column("content"), batch.column("positions").to_pylist(), strict=True):
                data = data.as_py()
                got = [parse_payload(read_frame(data, at)[1]) for at in spots]
                yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in got], pa.int64()), pa.array([x.tolist() for _, x in got], pa.list_(pa.int64())), pa.array(spots, pa.int64())], ["doc_id", "ids", "position"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    spots = index.groupBy("file").agg(F.sort_array(F.collect_list("position")).alias("positions"))
    found = named.join(spots, "file").select("content", "positions").mapInArrow(cut_out, "doc_id long, ids array<long>, position long")
    deal = F.xxhash64("doc_id", "position", F.lit(seed))
    return found.repartition(deal).sortWithinPartitions(deal).drop("position")


def encode_to_records(docs: DataFrame, tokenizer_path: str, end_id: int = 1, path: str | None = None, file_bytes: int | None = None) -> tuple[str, DataFrame]:
    """Write records and index, and return (records path, index with global starts)."""
    spark = docs.sparkSession
    path = path or scratch(spark, "records")
    write_records(docs, path, tokenizer_path, end_id, file_bytes)
    return path, write_index(spark, path, f"{path}-index")
