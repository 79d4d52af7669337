"""Importance resampling towards a target: documents drawn by how much likelier their n-grams are in the target.

Words, pairs and triples of words fall into hashed buckets. A bucket's gain is the rounded
log ratio of its smoothed counts in the target and in the corpus, and a document's weight
the sum of its features' gains, looked up in one array. A hash of the id adds Gumbel noise, so
that drawing the highest scores draws without replacement by weight. The last score drawn
is found by radix selection on the digits of (score, doc_id); only drawn rows are sorted.
"""

from __future__ import annotations

import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import number_rows, stored
from loomline.llm.selection import SIGN, kth_key

BUCKETS, GAIN_SCALE, LEAST_WORDS, DRAWN_PERCENT, SEED = 10_000, 1000, 20, 5, "42"
#: Every byte that is no ASCII letter or digit, and below 128, parts words; A-Z become a-z.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def feature_buckets(text: bytes | None) -> tuple[int, np.ndarray]:
    """(number of words, the bucket of each word, pair and triple) of a UTF-8 text."""
    words = (text or b"").translate(TABLE).split()
    # A checksum goes on from that of the words before.
    ones = list(map(crc32, words))
    further = [b" " + w for w in words[1:]]
    twos = list(map(crc32, further, ones))
    threes = list(map(crc32, further[1:], twos))
    return len(words), np.array(ones + twos + threes, np.uint32) % BUCKETS


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all texts of a table. A task gives BUCKETS rows at most, and so does the sum."""

    def scan(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                counts += np.bincount(feature_buckets(text)[1], minlength=BUCKETS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bucket", "n"])

    found = texts.select("text").mapInArrow(scan, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(BUCKETS, np.int64)
    for r in found.collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(GAIN_SCALE * ln) of the ratio of each bucket's shares in the target and in the corpus, counts smoothed by one."""
    of_corpus, of_target = int(corpus.sum()) + BUCKETS, int(target.sum()) + BUCKETS
    return np.array([math.floor(GAIN_SCALE * math.log(float(t + 1) * of_corpus / (float(s + 1) * of_target))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def scan(batches):
        own = shared.value
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                n, buckets = feature_buckets(text)
                rows.append((n, len(buckets), int(own[buckets].sum())))
            columns = zip(*rows, strict=True) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scan, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """Every document's (doc_id, n_words, n_features, weight, score, rank); rank is null for documents not drawn.

    Drawn are ``percent`` % (rounded down) of the documents with ``least_words`` words, by
    descending score, then ascending doc_id. A null text has no words and weight 0. A null
    doc_id is hashed as an empty one and comes before all others. Rows that are equal in
    score and doc_id are each drawn or not; which of them comes first is arbitrary but fixed once scored.
    Empty tables give no rows, or counts of none. Other columns are not read, whatever their names.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = weigh(docs, gain).withColumn("score", F.col("weight") + noise)
    # Keys in ascending order: the best score first, then the least id; the last tells repeated rows apart.
    keyed = scored.withColumns({"_best": F.bitwise_not("score"), "_id": F.coalesce("doc_id", F.lit(SIGN)), "_row": F.monotonically_increasing_id()})
    rows = stored(keyed, "scored")
    able = F.col("n_words") >= least_words
    k = rows.where(able).count() * percent // 100
    last = kth_key(rows.where(able), ["_best", "_id"], k)
    best, doc = last[0] if last else (SIGN, SIGN)
    drawn = able & F.lit(bool(last)) & ((F.col("_best") < best) | ((F.col("_best") == best) & (F.col("_id") <= doc)))
    ranked = number_rows(rows.where(drawn), [F.col("_best"), F.col("_id"), F.col("_row")], "rank").withColumn("rank", F.col("rank") + 1)
    # Of rows repeated at the last key, as many as are needed.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return rows.where(~drawn).withColumn("rank", F.lit(None).cast("long")).unionByName(ranked).drop("_best", "_id", "_row")
