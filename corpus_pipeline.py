"""The corpus pipeline: quality, toxicity, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns of
documents, with their own values: what a stage does not read is carried past its operator as one
struct, so no name can clash. A text that is null or empty has under 20 words and goes in the
first stage; an empty table gives an empty one in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.llm import jaccard, mixing, packing, quality, toxicity
from loomline.llm.common import scratch


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def carried(docs: DataFrame, reads: tuple[str, ...], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that an operator keeps, with the documents' own columns; it sees the columns that it reads and no others."""
    others = [c for c in docs.columns if c not in reads]
    rest = "_rest"
    while rest in docs.columns:
        rest += "_"
    packed = F.struct(*[docs[f"`{c.replace('`', '``')}`"].alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("none"))
    seen = docs.select(*[c for c in docs.columns if c in reads], packed.alias(rest))
    return operator(seen).select(*[F.col(c) if c in reads else F.col(rest).getField(f"c{others.index(c)}").alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules.

    Null and empty texts go. Repeated rows are judged alike. Without labels only the base rules and the smoothing's ratio decide.
    """
    return carried(docs, ("doc_id", "text"), lambda d: quality.judge(d, labels(spark, sf_dir)).where("kept"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below a half.

    A null or empty text has a toxicity and is kept or not like any other; so is a row without an id. Repeated rows are judged alike.
    """
    return carried(docs, ("doc_id", "text"), lambda d: toxicity.score_toxicity(d, labels(spark, sf_dir)).where("toxicity < 0.5"))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates (five words, similarity 0.8 or more).

    Texts without a word are near nothing and all stay. Of rows that tie in doc_id and text one stays.
    """
    return carried(docs, ("doc_id", "text"), lambda d: jaccard.keep_one(d, k=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, three times at most.

    A null source is the last one. Texts without a word are taken once. Of documents of one source
    and size, a hash of doc_id decides which are taken once more.
    """
    return carried(docs, ("doc_id", "text", "source"), lambda d: mixing.repeat_copies(mixing.mix(d, weights=(1, 2, 3), cap=3)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids, as sequences of power-of-two lengths of at most 4096 tokens.

    A null or empty text is its end id alone. Repeated rows are packed each.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, longest=4096)


STAGES = [
    ("quality rules", keep_good),
    ("toxicity", drop_toxic),
    ("near duplicates", keep_one_of_near_duplicates),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: SQL cannot express the fitted chain, nor components; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the last stage gives for the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
