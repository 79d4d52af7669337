"""Arriving events and game payloads as streams over the same plans as in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loomline.plans.datasets import STINT_RUNS, keyed_stints, on_court
from loomline.streaming.runs import stream_runs


def stream_games(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Payloads as they arrive in a directory, with the id of their file name."""
    reader = spark.readStream.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return reader.json(path).where("_corrupt_record is null").withColumn("_cid", F.regexp_replace(name, r"\.json$", ""))


def append_families(games: DataFrame, season: int, out: str, checkpoint: str, builders: dict[str, Callable[[DataFrame, int], DataFrame]]) -> StreamingQuery:
    """Run each builder on every arriving batch and write it under its batch's number, so a batch run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for name, build in builders.items():
            build(batch, season).write.mode("overwrite").parquet(f"{out}/{name}/batch={number}")
        batch.unpersist()

    return games.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_stints(events: DataFrame, season: int, ts: str, idle: str = "1 hour") -> DataFrame:
    """Matchup stints as they close, from single events that arrive game by game in order of ``_pos``, with a watermark on ``ts``.

    The same rows as ``datasets.matchup_stints``, but for games that lack all values of a
    needed column: that is not known before their end, so they are not left out.
    """
    return keyed_stints(stream_runs(on_court(events), partition=["contest_id"], order=["_pos"], ts=ts, idle=idle, **STINT_RUNS), season)


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events and their sum of values per type and window; rows later than the watermark are left out of closed windows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
