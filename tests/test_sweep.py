"""Seasons that are built at the same time."""

import threading

from pyspark.sql import functions as F

from loomline.plans import sweep


def test_pending_units(spark):
    units = [(d, s) for s in (2023, 2022) for d in ("pbp", "shots")]
    assert {tuple(r) for r in sweep.pending(spark, units, [("pbp", 2023), ("x", 1)]).collect()} == {("shots", 2023), ("pbp", 2022), ("shots", 2022)}
    assert sweep.pending(spark, units, []).count() == 4
    assert sweep.by_season(units) == {2023: ["pbp", "shots"], 2022: ["pbp", "shots"]} and list(sweep.by_season(units)) == [2023, 2022]


def test_seasons_interleave_and_one_failure_stops_neither(spark):
    meet, built, pools, done = threading.Barrier(2, timeout=120), [], {}, []

    def build(name, season):
        if name == "fails" and season == 2023:
            raise RuntimeError("x")
        n = spark.range(1000).where(F.col("id") % 2 == 0).count()
        meet.wait()  # only passes while the other season is being built too
        pools[season] = spark.sparkContext.getLocalProperty(sweep.POOL)
        built.append((name, season, n))
        meet.wait()

    seasons = {2023: ["a", "fails", "b"], 2022: ["a", "b"]}
    assert sweep.run_units(seasons, build, 2, done.append) == [("fails", 2023)]
    assert sorted(built) == [(d, s, 500) for d in "ab" for s in (2022, 2023)] and sorted(done) == [2022, 2023]
    assert pools == {2022: "season-2022", 2023: "season-2023"} and spark.sparkContext.getLocalProperty(sweep.POOL) is None
    assert {s for _, s, _ in built[:2]} == {2022, 2023}


def test_one_season_at_a_time(spark):
    built = []
    assert sweep.run_units({2: ["a", "b"], 1: ["a"]}, lambda name, season: built.append((season, name)), 1) == []
    assert built == [(2, "a"), (2, "b"), (1, "a")]
