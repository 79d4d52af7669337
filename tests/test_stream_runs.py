"""Runs and stints on a stream against the same in batch, over many batches and a restart."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loomline.operators.segments import gaps_and_islands
from loomline.plans import datasets
from loomline.schemas import ON_COURT
from loomline.streaming import arrivals, runs

WHAT = {
    "change": ["kind", "flag"], "firsts": {"kind": "kind", "first_n": "n"}, "lasts": {"last_n": "n", "value": "value"}, "distincts": {"n_tags": "tag"},
    "count": "rows", "starts": {"value_before": "value"}, "deltas": {"n_more": "last_n"},
}
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def rocks(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, runs.PROVIDER)
    yield spark
    spark.conf.set(key, before)


def arrive(spark, rows, schema, folder, parts, first=0):
    """Files that a stream reads one after the other."""
    for i in range(parts):
        part = rows[len(rows) * i // parts : len(rows) * (i + 1) // parts]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{first + i:03d}")


def drain(spark, folder, schema, make, out, checkpoint):
    """Run the stream over what has arrived, a file a batch, and stop; called again it goes on from its checkpoint."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder).withWatermark("ts", "1 minute")
    make(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


def same(spark, got, want):
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert rows(got) == rows(want)


def test_runs_of_a_stream_are_those_of_the_batch(rocks, tmp_path):
    spark, rng, schema = rocks, random.Random(4), "user long, n long, ts timestamp, kind string, flag int, value double, tag string"
    kinds = {u: "a" for u in range(6)}
    rows = []
    for n in range(400):
        u = rng.choice([0, 0, 0, 1, 2, 3, 4, 5])
        kinds[u] = rng.choice([kinds[u], kinds[u], kinds[u], "a", "b", None])
        rows.append((u, n, T0 + dt.timedelta(seconds=n), kinds[u], rng.choice([1, 1, 1, 2, None]) if u == 1 else 1, rng.choice([None, n / 4]), rng.choice(["x", "y", "z", None])))
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    make = lambda df: runs.stream_runs(df, partition=["user"], order=["n"], ts="ts", idle="10 minutes", **WHAT)
    # Within a batch rows come in any order.
    mixed = [r for i in range(0, 400, 40) for r in rng.sample(rows[i : i + 40], 40)]
    arrive(spark, mixed[:200], schema, folder, 5)
    drain(spark, folder, schema, make, out, checkpoint)
    closed = spark.read.parquet(out).count()
    assert closed > 20
    arrive(spark, mixed[200:], schema, folder, 5, first=5)
    arrive(spark, [(99, 1000 + i, T0 + dt.timedelta(hours=9 + i), "end", 1, 0.0, None) for i in range(2)], schema, folder, 2, first=10)
    drain(spark, folder, schema, make, out, checkpoint)  # a new query, from the checkpoint
    want = gaps_and_islands(spark.createDataFrame(rows, schema), partition=["user"], order=["n"], **WHAT)
    assert want.count() > closed
    same(spark, spark.read.parquet(out).where("user < 99"), want)


def test_stints_of_a_stream_are_those_of_the_batch(rocks, tmp_path):
    spark, rng = rocks, random.Random(6)
    names = [f"{c}.PLAYER" for c in "ABCDEFG"]
    schema = "contest_id string, _pos int, ts timestamp, period long, game_seconds long, home_score long, away_score long, home string, away string, game_date string, poss_num long, " + ", ".join(f"{c} string" for c in ON_COURT)
    games, rows = {g: [0, 0, names[:5], names[1:6]] for g in "12"}, []
    for i in range(240):
        g = rng.choice("12")
        state = games[g]
        state[rng.randrange(2)] += rng.choice([0, 0, 2, 3])
        for side in (2, 3):
            if rng.random() < 0.15:
                state[side] = rng.sample(names, 5)
        rows.append((g, i, T0 + dt.timedelta(seconds=i), 1 + i // 120, i * 5, state[0], state[1], f"Home {g}", "Away", "01/01/2024", rng.choice([None, i // 4]), *state[2], *(state[3] if rng.random() > 0.05 else [None, *state[3][1:]])))
    last = [("end", 1000 + i, T0 + dt.timedelta(hours=9 + i), 1, 0, 0, 0, "H", "A", None, None, *names[:5], *names[:5]) for i in range(2)]
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    make = lambda df: arrivals.stream_stints(df, 2024, "ts", "10 minutes")
    arrive(spark, rows[:120], schema, folder, 3)
    drain(spark, folder, schema, make, out, checkpoint)
    arrive(spark, rows[120:], schema, folder, 3, first=3)
    arrive(spark, last, schema, folder, 2, first=6)
    drain(spark, folder, schema, make, out, checkpoint)
    events = [f"{c}" for c in schema.split(", ")]
    fields = [e.split()[0] for e in events if e.split()[0] not in ("contest_id", "_pos", "ts")]
    listed = spark.createDataFrame(rows, schema).groupBy("contest_id").agg(F.array_sort(F.collect_list(F.struct("_pos", F.struct(*fields).alias("e")))).alias("l"))
    want = datasets.matchup_stints(listed.select("contest_id", F.transform("l", lambda x: x["e"]).alias("pbp")), 2024)
    assert want.count() > 30
    same(spark, spark.read.parquet(out).where("contest_id <> 'end'"), want)
