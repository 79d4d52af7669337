"""Packing by power-of-two decomposition: no sequence crosses documents, and none needs padding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import number_rows, scratch
from loomline.llm.tokens import encoder, release, slices

PIECES = "doc_id long, piece long, start long, length long, ids binary, doc_tokens long"


def piece_lengths(sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths of the pieces of all documents in turn, pieces of each document).

    A document's are as many of the longest as fit, then the powers of two of the rest's
    binary digits, descending.
    """
    powers = np.arange(longest.bit_length() - 2, -1, -1)
    full, digits = sizes // longest, (sizes % longest)[:, None] >> powers & 1
    counts = full + digits.sum(1)
    base = np.cumsum(counts) - counts
    lengths = np.full(int(counts.sum()), longest, np.int64)
    doc, digit = np.nonzero(digits)
    lengths[base[doc] + full[doc] + digits.cumsum(1)[doc, digit] - 1] = 1 << powers[digit]
    return lengths, counts


def with_ends(flat: np.ndarray, at: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in turn, each with the end id behind it; how many each has)."""
    sizes = np.diff(at) + 1
    ends = np.cumsum(sizes) - 1
    ids, own = np.full(int(sizes.sum()), end_id, "<u4"), np.ones(int(sizes.sum()), bool)
    own[ends] = False
    ids[own] = flat[at[0] : at[-1]]
    return ids, sizes


def decompose(docs: DataFrame, tokenizer_path: str, end_id: int = 2, longest: int = 4096) -> DataFrame:
    """The pieces of every document with their ids (uint32, little-endian), one row each.

    A document's tokens are its ids and ``end_id``; a null or empty text gives the end id
    alone. Repeated rows are packed as often as they occur. Only doc_id and text are read.
    """
    if longest & (longest - 1):
        raise ValueError("the longest length must be a power of two")

    def cut_up(batches):
        enc = encoder(tokenizer_path)
        names = [x.split()[0] for x in PIECES.split(", ")]
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts):
                ids, sizes = with_ends(*enc.encode(texts[a:b]), end_id)
                lengths, counts = piece_lengths(sizes, longest)
                ends, doc = np.cumsum(lengths), np.repeat(np.arange(b - a), counts)
                first = np.cumsum(counts) - counts
                start = ends - lengths - (np.cumsum(sizes) - sizes)[doc]
                # Pieces follow each other as the ids do, so the column is the ids with offsets.
                cuts = pa.py_buffer(np.concatenate([[0], 4 * ends]).astype(np.int32))
                pieces = pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, cuts, pa.py_buffer(ids)])
                columns = [batch.column("doc_id")[a:b].take(pa.array(doc)), pa.array(np.arange(len(doc)) - first[doc]), pa.array(start), pa.array(lengths), pieces, pa.array(sizes[doc])]
                yield pa.RecordBatch.from_arrays(columns, names)
                del ids, pieces, columns, cuts
            del batch, texts
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut_up, PIECES)


def bucket_sequences(pieces: DataFrame) -> DataFrame:
    """Number the pieces bucket by bucket, the longest first; each piece is a sequence of its own.

    Within a bucket, sequences follow doc_id (nulls first), start and content; other
    columns are kept.
    """
    order = [F.col("length").desc(), F.col("doc_id").asc_nulls_first(), F.col("start"), F.col("ids_crc32")]
    return number_rows(pieces, order, "sequence_id").withColumn("offset", F.lit(0).cast("long"))


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, longest: int = 4096, keep_ids: bool = True) -> DataFrame:
    """Sequences of every document's tokens: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    The checksum is made where the ids are, so that only the small digest columns are dealt
    out to be numbered. Pieces with their ids are written once; their numbers come back to
    them by a key that is written with them.
    """
    pieces = decompose(docs, tokenizer_path, end_id, longest).withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        return bucket_sequences(pieces.drop("piece", "ids"))
    path = scratch(docs.sparkSession, "pieces")
    pieces.drop("piece").withColumn("_piece", F.monotonically_increasing_id()).write.parquet(path, compression="zstd")
    keyed = docs.sparkSession.read.parquet(path)
    numbers = bucket_sequences(keyed.drop("ids", "doc_tokens")).select("_piece", "sequence_id", "offset")
    # The numbers are the side held in memory, some 24 bytes a piece; the ids stream past them unsorted.
    return keyed.join(numbers.hint("shuffle_hash"), "_piece").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
