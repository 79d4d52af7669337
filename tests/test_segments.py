"""Segments of hot keys against those of a single scan."""

import random

import pytest
from pyspark.sql import functions as F

from loomline.operators import segments

WHAT = {
    "change": ["kind", "flag"], "firsts": {"kind": "kind", "first_n": "n"}, "lasts": {"last_n": "n", "value": "value"}, "distincts": {"n_tags": "tag"},
    "count": "rows", "starts": {"value_before": "value"}, "deltas": {"n_more": "last_n"},
}


def rows(seed, n=600):
    """A null key and a key with most rows, ties and nulls in the order, runs longer than a slice, nulls that break runs."""
    rng, kind, out = random.Random(seed), "a", []
    for i in range(n):
        kind = rng.choice([kind] * 30 + ["a", "b", None])
        out.append((rng.choice([None, 1, 7, 7, 7, 7, 7, 7, 7, 7]), rng.choice([None, i // 7, i // 7, i // 50]), i, kind, rng.choice([1] * 40 + [2, None]), rng.choice([None, i / 4]), rng.choice(["x", "y", "z", None])))
    return out


@pytest.mark.parametrize("broadcast", [segments.BROADCAST_ROWS, 0])
@pytest.mark.parametrize("hot_rows", [10, 60, 400, 10_000])
def test_slices_change_nothing(spark, monkeypatch, hot_rows, broadcast):
    monkeypatch.setattr(segments, "BROADCAST_ROWS", broadcast)
    df = spark.createDataFrame(rows(hot_rows), "user long, t long, n long, kind string, flag int, value double, tag string")
    make = lambda **kw: segments.gaps_and_islands(df.repartition(4), partition=["user"], order=["t", "n"], **WHAT, **kw)
    want, got = make(), make(hot_rows=hot_rows)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_one_hot_key_is_many_tasks(spark):
    """No task sees a third of a key that has nine tenths of all rows."""
    df = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("user"), "id", (F.col("id") % 500).alias("kind"))
    cuts = segments.hot_slices(df, ["user"], "id", 1000)
    assert cuts[1] and cuts[0].count() == 1
    numbered = segments.numbered_in_slices(df.repartition(6), ["user"], ["id"], ["kind"], "segment", [], *cuts)
    tasks = numbered.withColumn("task", F.spark_partition_id()).where("user = 0").groupBy("task").count().collect()
    assert len(tasks) >= 4 and max(r["count"] for r in tasks) <= 6000 * 1.5
    assert numbered.where("user = 0").agg(F.max("segment"), F.count_distinct("segment")).first()[:] == (18_000, 18_000)


def test_what_cannot_be_sliced_is_refused(spark):
    df = spark.createDataFrame([("a", "x", 1)], "k string, o string, v long")
    with pytest.raises(TypeError):
        segments.gaps_and_islands(df, partition=["k"], order=["o"], change=["v"], hot_rows=1)
    with pytest.raises(ValueError):
        segments.gaps_and_islands(df, partition=["k"], order=["o"], change=["v"], count="n", deltas={"more": "n"})
