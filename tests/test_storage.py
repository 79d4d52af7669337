"""Season commits, csv.gz members, stores of both kinds, and payloads as variants."""

import csv
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline import registry, sinks, storage
from loomline.sources import games as source

PBP = registry.dataset("pbp")


@pytest.fixture(params=["local", "hadoop"])
def store(request, spark, monkeypatch):
    if request.param == "local":
        return storage.LocalStore()
    monkeypatch.setattr(sinks, "store_for", lambda path, spark=None: storage.HadoopStore(spark))
    return storage.HadoopStore(spark)


def test_stores_do_the_same(store, tmp_path):
    at = f"file://{tmp_path}/a"
    assert store.names(at) == [] and not store.exists(at)
    store.write(f"{at}/x.txt", "ä1")
    store.write(f"{at}/y.txt", "2")
    assert store.names(at) == ["x.txt", "y.txt"] and store.read(f"{at}/x.txt") == "ä1" and store.size(f"{at}/x.txt") == 3 and store.size(at) == 4
    store.join(b"0", [f"{at}/x.txt", f"{at}/y.txt"], f"{at}/b/z")
    assert store.read(f"{at}/b/z") == "0ä12" and store.modified(f"{at}/b/z") > 0
    with pytest.raises(FileExistsError):
        store.move(f"{at}/x.txt", f"{at}/y.txt")
    store.replace(f"{at}/x.txt", f"{at}/y.txt")
    assert store.read(f"{at}/y.txt") == "ä1" and not store.exists(f"{at}/x.txt")
    store.move(f"{at}/b", f"{at}/c/d")
    with open(store.fetch(f"{at}/c/d/z")) as f:
        assert f.read() == "0ä12"
    store.prune(f"{at}/c")
    assert store.exists(f"{at}/c/d/z")
    store.delete(f"{at}/c")
    store.delete(f"{at}/c")
    store.make(f"{at}/e")
    store.prune(f"{at}/e")
    assert not store.exists(f"{at}/e")
    assert [n for n in store.names(at) if not n.startswith(".")] == ["y.txt"]
    assert storage.is_local("/a") and storage.is_local("file:///a") and not storage.is_local("hdfs://x/a")


def state(spark, base):
    rows = sorted(r["n"] for r in source.read_committed(spark, base, "wbb", "pbp").where("season = 2023").collect())
    manifest = {r["season"]: r["row_count"] for r in source.read_manifest(spark, f"{base}/wbb/pbp/manifest.csv").collect()}
    return rows, manifest


def test_a_season_and_its_manifest_row_go_together(store, spark, tmp_path):
    base = f"file://{tmp_path}"
    numbers = lambda n: spark.range(n).select(F.col("id").alias("n"), F.lit(9).alias("season"))
    assert sinks.commit_season(numbers(2), PBP, 2022, base, "wbb") == 2 and sinks.commit_season(numbers(3), PBP, 2023, base, "wbb") == 3
    before = state(spark, base)
    assert before == ([0, 1, 2], {2022: 2, 2023: 3})
    # A task that dies half way, after others have ended.
    failing = spark.range(0, 8, 1, 4).select(F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("n"))
    with pytest.raises(Exception, match="lost"):
        sinks.commit_season(failing, PBP, 2023, base, "wbb")
    assert state(spark, base) == before and store.names(f"{base}/wbb/pbp/_staging") == []
    assert sinks.commit_season(numbers(0), PBP, 2023, base, "wbb") == 0 and state(spark, base) == before
    assert sinks.commit_season(numbers(5), PBP, 2023, base, "wbb") == 5
    assert state(spark, base) == ([0, 1, 2, 3, 4], {2022: 2, 2023: 5})


@pytest.mark.parametrize("dies_at", ["store.move", "staged", "old away", "season in place", "manifest"])
def test_a_driver_that_dies_is_made_good(spark, tmp_path, monkeypatch, dies_at):
    """Before the journal is written the old state stays; after it, the next call ends the commit."""
    base, number = str(tmp_path), {"old away": 2, "season in place": 3}.get(dies_at)
    rows = lambda n: spark.range(n).select(F.col("id").alias("n"))
    sinks.commit_season(rows(2), PBP, 2023, base, "wbb")
    moves, move = [], storage.LocalStore.move

    def dying(self, a, b):
        moves.append(a)
        if dies_at == "store.move" and len(moves) == 1 or len(moves) == number:
            raise KeyboardInterrupt
        move(self, a, b)

    def stop(*a, **kw):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(storage.LocalStore, "move", dying)
        if dies_at == "staged":
            m.setattr(sinks, "roll_forward", stop)
        if dies_at == "manifest":
            m.setattr(sinks, "upsert_manifest", stop)
        with pytest.raises(KeyboardInterrupt):
            sinks.commit_season(rows(4), PBP, 2023, base, "wbb")
    sinks.recover(spark, f"{base}/wbb/pbp", 2023)
    assert state(spark, base) == (([0, 1], {2023: 2}) if dies_at == "store.move" else ([0, 1, 2, 3], {2023: 4}))
    assert not os.path.exists(f"{base}/wbb/pbp/_staging")


def test_csv_members_are_made_in_parallel_and_alike(store, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "PART_ROWS", 100)
    rows = [(str(i % 7) if i % 5 else None, i % 50, i / 3, f' q"{i},\n' if i % 11 else "") for i in range(1000)]
    df = spark.createDataFrame(rows, "contest_id string, period int, x double, note string")
    first, second = f"{tmp_path}/a.csv.gz", f"{tmp_path}/b.csv.gz"
    sinks.write_csv_gz(df.repartition(3), first, ["contest_id", "period"])
    sinks.write_csv_gz(df.orderBy(F.col("x").desc()).repartition(11), second, ["contest_id", "period"])
    with open(first, "rb") as a, open(second, "rb") as b:
        data = a.read()
        assert data == b.read() and data.count(b"\x1f\x8b\x08") >= 8
    assert not any("parts" in n for n in os.listdir(tmp_path))
    with gzip.open(first, "rt", newline="") as f:
        head, *got = csv.reader(f)
    key = lambda r: (r[0] is not None, r[0] or "", r[1], r[2])
    assert head == df.columns and got == [[r[0] or "", str(r[1]), str(r[2]), r[3]] for r in sorted(rows, key=key)]


def test_payloads_as_variants(spark, tmp_path):
    bodies = {
        "1": {"contest_id": 1, "pbp": [{"period": 1, "home": "A", "clock": 5, "extra": {"a": [1, "x"]}}], "shots": [{"x": 1, "label": 7}]},
        "2": {"contest_id": "2", "pbp": [{"period": "soon", "home": 3, "clock": 1.5, "odd name`": True}], "shots": [{"x": 2.5, "label": "seven"}], "player_box": None},
        "3": {"contest_id": "3", "pbp": {"no": "array"}},
    }
    for name, body in bodies.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    for name, body in {"4": '{"pbp": [', "5": "", "6": "[1, 2]", "7": '"text"'}.items():
        (tmp_path / f"{name}.json").write_text(body)
    payloads = source.Payloads(source.payload_texts(spark, str(tmp_path)))
    assert (payloads.absent, payloads.failed) == (0, 3)  # Spark does not list files without a byte
    assert payloads.refused == {"pbp": 1, "lineups": 0, "player_box": 0, "team_box": 0, "shots": 0, "possessions": 0}
    got = {r["_cid"]: r for r in payloads.games().collect()}
    assert sorted(got) == ["1", "2", "3"] and [got[i].contest_id for i in "123"] == ["1", "2", "3"]
    kinds = {f.name: f.dataType for f in payloads.schema["pbp"].dataType.elementType}
    assert kinds["clock"] == T.DoubleType() and kinds["period"] == T.LongType() and kinds["odd name`"] == T.BooleanType() and kinds["home"] == T.StringType()
    one, two = got["1"].pbp[0], got["2"].pbp[0]
    assert (one.period, one.home, one.clock, one.home_1) == (1, "A", 5.0, None) and (two.period, two.home, two.clock, two["odd name`"]) == (None, "3", 1.5, True)
    assert [s.label for i in "12" for s in got[i].shots] == ["7", "seven"] and [s.x for i in "12" for s in got[i].shots] == [1.0, 2.5]
    assert got["3"].pbp is None and got["2"].player_box is None and got["1"].lineups is None
    payloads.release()
    assert source.Payloads(spark.createDataFrame([("1", None)], "_cid string, payload string")).absent == 1
    assert source.Payloads(spark.createDataFrame([], "_cid string, payload string")).games().count() == 0


def test_one_game_of_another_kind_leaves_a_family_its_columns(spark):
    bodies = ['{"shots": [{"x": 1}, 5]}', '{"shots": [{"x": 2, "y": "a"}]}', '{"shots": [3]}', '{"shots": "none"}', '{"shots": []}', '{"shots": null}', "{}"]
    payloads = source.Payloads(spark.createDataFrame(list(enumerate(bodies)), "_cid string, payload string"))
    assert payloads.refused["shots"] == 2 and payloads.schema["shots"].dataType.elementType.names == ["x", "y"]
    got = {r["_cid"]: r.shots for r in payloads.games("shots").collect()}
    assert [tuple(s) for s in got["1"]] == [(2, "a")] and got["0"][0].x == 1 and got["3"] is None and got["4"] == [] and got["6"] is None


def test_the_raw_tree_is_found_beside(spark, tmp_path, monkeypatch):
    monkeypatch.delenv(source.ROOT_ENV, raising=False)
    for name in ("a-raw/other", "b-raw/wbb/raw/2023", "data"):
        (tmp_path / name).mkdir(parents=True)
    assert source.bundle_tree(spark, None, "wbb/raw", f"{tmp_path}/data") == f"{tmp_path}/b-raw/wbb/raw"
    assert source.bundle_tree(spark, f"{tmp_path}/b-raw", "wbb/raw") == f"{tmp_path}/b-raw/wbb/raw" and source.bundle_tree(spark, f"{tmp_path}/data", "wbb/raw") == f"{tmp_path}/data"
    with pytest.raises(ValueError):
        source.bundle_tree(spark, None, "wbb/none", f"{tmp_path}/data")
