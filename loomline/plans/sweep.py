"""Several seasons at once: each in a thread and scheduler pool of its own, over one parse of its games."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger("loomline")
POOL = "spark.scheduler.pool"


def pending(spark: SparkSession, units: Iterable[tuple[str, int]], live: Iterable[tuple[str, int]]) -> DataFrame:
    """(dataset, season) of the units that are not live."""
    schema = "dataset string, season long"
    return missing_units(spark.createDataFrame(list(units), schema), spark.createDataFrame(list(live), schema))


def missing_units(units: DataFrame, live: DataFrame) -> DataFrame:
    """Distinct (dataset, season) of one table that the other lacks."""
    return units.select("dataset", "season").distinct().join(live.select("dataset", "season").distinct(), ["dataset", "season"], "left_anti")


def by_season(units: Iterable[tuple[str, int]]) -> dict[int, list[str]]:
    """Datasets of each season, in the units' order."""
    found: dict[int, list[str]] = {}
    for name, season in units:
        found.setdefault(season, []).append(name)
    return found


def run_units(seasons: dict[int, list[str]], build: Callable[[str, int], object], parallel: int, finish: Callable[[int], object] | None = None) -> list[tuple[str, int]]:
    """Build every unit, so many seasons at a time; returns those that failed, which stop no other.

    A season's units follow each other, as they share what was parsed. With a fair scheduler
    (``spark.scheduler.mode=FAIR``), seasons share the executors' cores job by job.
    """
    spark = SparkSession.getActiveSession()

    def run(season: int) -> list[tuple[str, int]]:
        if spark:
            spark.sparkContext.setLocalProperty(POOL, f"season-{season}")
        failed = []
        try:
            for name in seasons[season]:
                try:
                    build(name, season)
                except Exception:  # noqa: BLE001 -- whatever ails one unit, the sweep goes on and tells
                    log.exception("%s %s failed", name, season)
                    failed.append((name, season))
        finally:
            if finish:
                finish(season)
            if spark:
                spark.sparkContext.setLocalProperty(POOL, None)
        return failed

    if parallel <= 1:
        return [unit for season in seasons for unit in run(season)]
    with ThreadPoolExecutor(parallel, "season") as threads:
        # A target each, as the properties that a thread inherits are the target's own.
        tasks = [threads.submit(inheritable_thread_target(spark)(run) if spark else run, season) for season in seasons]
        return [unit for task in tasks for unit in task.result()]
