"""Bitmaps over numbered keys against sets, and presence that is renewed season by season."""

import random

import pytest
from pyspark.sql import functions as F

from loomline import registry, sinks
from loomline.operators import bitmaps, relational
from loomline.plans import presence


def test_flags_are_those_of_a_join(spark):
    rng = random.Random(8)
    index = spark.createDataFrame([(str(i) if i else None, i % 3) for i in range(3000)] + [("7", 9)], "k string, x long")
    members = {n: spark.createDataFrame([(str(rng.randrange(4000)),) for _ in range(size)], "k string") for n, size in (("a", 2500), ("b", 3), ("c", 0))}
    numbers = bitmaps.number_keys(index, "k")
    assert numbers.agg(F.count("number"), F.count_distinct("number"), F.count_distinct("k")).first()[:] == (2999, 2999, 2999)
    made = {n: bitmaps.bitmaps_of(df, numbers, "k") for n, df in members.items()}
    # The same page in several rows is united.
    made["a"] = bitmaps.bitmaps_of(members["a"].limit(1000), numbers, "k").union(bitmaps.bitmaps_of(members["a"], numbers, "k"))
    got, want = bitmaps.bitmap_flags(index.withColumn("b", F.lit("clash")), numbers, "k", made), relational.presence_flags(index, "k", members)
    rows = lambda df: sorted(map(str, df.select("k", "x", "a", "b", "c").collect()))
    assert rows(got) == rows(want) and bitmaps.bitmap_flags(index, numbers, "k", {}).columns == ["k", "x"]


def test_numbers_stay_as_keys_come(spark):
    first = bitmaps.number_keys(spark.range(100).selectExpr("cast(id as string) k"), "k").cache()
    later = bitmaps.number_keys(spark.range(50, 300).selectExpr("cast(id as string) k"), "k", first).cache()
    assert later.count() == 200 and first.union(later).agg(F.count_distinct("number")).first()[0] == 300
    per_bucket = first.union(later).groupBy(F.floor(F.col("number") / bitmaps.SPAN)).agg((F.max("number") % bitmaps.SPAN + 1 == F.count("*")).alias("dense"))
    assert all(r.dense for r in per_bucket.collect())


def test_only_new_seasons_are_read(spark, tmp_path):
    base = str(tmp_path)
    ids = lambda *n: spark.createDataFrame([(str(i), i) for i in n], "contest_id string, v long")
    index = spark.createDataFrame([(2023, str(i)) for i in range(20)], "season long, contest_id string")
    pbp, shots = registry.dataset("pbp"), registry.dataset("shots")
    for d, season, df in ((pbp, 2022, ids(1, 2, 99)), (pbp, 2023, ids(3, 3)), (shots, 2023, ids(1))):
        sinks.commit_season(df, d, season, base, "wbb")

    def flags():
        numbers, found, read = presence.renew(spark, index, base, "wbb", ["pbp", "shots", "lineups"])
        rows = bitmaps.bitmap_flags(index, numbers, "contest_id", found).collect()
        return {n: sorted(int(r.contest_id) for r in rows if r[n]) for n in found}, read

    assert flags() == ({"pbp": [1, 2, 3], "shots": [1]}, [("pbp", 2022), ("pbp", 2023), ("shots", 2023)])
    assert flags() == ({"pbp": [1, 2, 3], "shots": [1]}, [])
    with pytest.MonkeyPatch.context() as m:
        m.setattr(sinks, "now_text", lambda: "2030-01-01 00:00:00 UTC")
        sinks.commit_season(ids(4, 5), pbp, 2023, base, "wbb")
    assert flags() == ({"pbp": [1, 2, 4, 5], "shots": [1]}, [("pbp", 2023)])
    index = index.union(spark.createDataFrame([(2024, "99")], index.schema))
    sinks.commit_season(ids(99), registry.dataset("lineups"), 2024, base, "wbb")
    assert flags() == ({"pbp": [1, 2, 4, 5, 99], "shots": [1], "lineups": [99]}, [("lineups", 2024)])
    with pytest.raises(TypeError):
        sinks.commit_season(spark.range(3).withColumnRenamed("id", "contest_id"), registry.dataset("team_box"), 2023, base, "wbb")
        presence.renew(spark, index, base, "wbb", ["team_box"])
