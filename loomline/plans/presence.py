"""Presence of contests in committed datasets, kept as bitmaps, so that a new season is the only one that is read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.operators.bitmaps import bitmaps_of, number_keys
from loomline.operators.relational import require_column
from loomline.sources.games import path_exists, read_committed, read_manifest
from loomline.storage import store_for

KEY = "contest_id"


def folder(base: str, league: str) -> str:
    return f"{base}/{league}/_presence"


def renew_numbers(spark: SparkSession, index: DataFrame, base: str, league: str) -> DataFrame:
    """(contest_id, number) of all contests that were ever in the index; new ones are appended."""
    path = f"{folder(base, league)}/numbers"
    known = spark.read.parquet(path) if path_exists(spark, f"{path}/_SUCCESS") else None
    number_keys(index, KEY, known).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def stamps(spark: SparkSession, base: str, league: str, name: str) -> dict[int, str]:
    """When each committed season of a dataset was built, by its manifest; a season that this lacks counts as built once."""
    seasons = [int(n.removeprefix("season=")) for n in store_for(base, spark).names(f"{base}/{league}/{name}/parquet") if n.startswith("season=")]
    built = {r["season"]: r["generated_at_utc"] for r in read_manifest(spark, f"{base}/{league}/{name}/manifest.csv").collect()}
    return {s: built.get(s, "") for s in seasons}


def renew(spark: SparkSession, index: DataFrame, base: str, league: str, names: list[str]) -> tuple[DataFrame, dict[str, DataFrame], list[tuple[str, int]]]:
    """(numbers, bitmaps of each committed dataset, the (dataset, season) that were read).

    Only seasons built since their bitmaps were made are read, and of those only the ids. Their
    contests are numbered whether the index has them or not, so that bitmaps hold when it grows.
    """
    require_column(index, KEY, "string", "schedule index")
    store, root = store_for(base, spark), f"{folder(base, league)}/bitmaps"
    kept: dict[tuple[str, int], str] = {}
    if path_exists(spark, f"{root}/dataset=*/season=*"):
        kept = {(r["dataset"], r["season"]): r["stamp"] for r in spark.read.parquet(root).select("dataset", "season", "stamp").distinct().collect()}
    live, unread = {}, {}
    for name in names:
        committed = read_committed(spark, base, league, name, [KEY, "season"])
        if committed is not None:
            require_column(committed, KEY, "string", name)
            live[name] = stamps(spark, base, league, name)
            unread |= {(name, s): committed.where(F.col("season") == s).select(KEY) for s, stamp in live[name].items() if kept.get((name, s)) != stamp}
    numbers = renew_numbers(spark, reduce(lambda a, b: a.union(b), unread.values(), index.select(KEY)), base, league)
    for (name, season), ids in unread.items():
        bitmaps_of(ids, numbers, KEY).withColumn("stamp", F.lit(live[name][season])).write.mode("overwrite").parquet(f"{root}/dataset={name}/season={season}")
    found = {}
    for name, seasons in live.items():
        paths = [path for s in seasons if store.names(path := f"{root}/dataset={name}/season={s}")]
        found[name] = spark.read.schema("page long, bits binary, stamp string").parquet(*paths).select("page", "bits")
    return numbers, found, list(unread)
