import gzip
import json
import os
import unicodedata

import pytest
from pyspark.sql import functions as F

from loomline import cli, publish, registry, schemas, sinks
from loomline.functions import pages, text
from loomline.plans import build, coverage, datasets, game_queries, name_changes
from loomline.sources import games as source
from loomline.sources import http
from loomline.streaming import arrivals
from tests import games as G


@pytest.fixture(scope="module")
def tree(tmp_path_factory, spark):
    root = str(tmp_path_factory.mktemp("raw"))
    G.write_tree(root)
    index = [("101", "2023", "True"), ("102", "2023", "True"), ("103", "2023", "True"), ("104", "2023", "False"), ("105", "2023", "False"), ("999", "2022", "True")]
    spark.createDataFrame(index, "contest_id string, season string, captured string").coalesce(1).write.parquet(f"{root}/wbb/schedule_master.parquet")
    return root


@pytest.fixture(scope="module")
def inputs(spark, tree):
    crosswalk = spark.createDataFrame([(7, "Alder", "2022-23"), (8, "Birch St.", "2023-24")], "id long, team string, season string")
    return build.Season(spark, 2023, tree, "wbb", crosswalk)


def test_catalog():
    assert len(registry.CATALOG) == 11 and len(registry.flag_columns()) == 8
    with pytest.raises(ValueError):
        registry.dataset("nothing")


def test_games_of_a_season_and_the_missing(spark, tree):
    index = source.read_index(spark, tree, "wbb")
    ids = source.season_ids(index, 2023)
    found, missing = source.split_by_presence(source.payload_texts(spark, f"{tree}/wbb/json"), ids)
    assert sorted(r["_cid"] for r in found.collect()) == ["101", "102", "103", "104"]
    assert [r[0] for r in missing.collect()] == ["105"]
    payloads = source.Payloads(found)
    assert sorted(r["_cid"] for r in payloads.games().collect()) == ["101", "102", "103"] and (payloads.absent, payloads.failed) == (0, 1)
    assert source.read_index(spark, tree, "none") is None


def test_stints(inputs):
    rows = build.build(inputs, "matchup_stints").collect()
    assert rows[0].__fields__[:15] == datasets.STINT_FRONT
    got = [(r.contest_id, r.game_stint_num, r.period, r.start_seconds, r.end_seconds, r.home_pts, r.away_pts, r.n_events, r.n_possessions) for r in rows]
    assert got == [("101", 1, 1, 10, 40, 2, 0, 3, 2), ("101", 2, 1, 60, 90, 4, 3, 2, 1), ("101", 3, 2, 100, 100, 0, 2, 1, 1)]
    assert rows[0].home_1 == "ANA.BERG" and rows[1].home_5 == "ZOE.YORK" and rows[0].matchup_key == f"{rows[0].home_lineup_key}_{rows[0].away_lineup_key}"
    assert rows[0].away_lineup_key == rows[1].away_lineup_key and rows[0].home_lineup_key != rows[1].home_lineup_key


def test_lineups_join_stints_by_key(inputs):
    rows = build.build(inputs, "lineups").collect()
    assert len(rows[0].__fields__) == 77
    assert [r.stint_num for r in rows] == [2, 1, None, 3]
    assert [r.player_5 for r in rows] == ["Ford, Eva", "Ford, Eva", None, "Ford, Eva"]
    assert rows[1].opp_pts is None and rows[0].opp_pts == 4 and rows[0].rim_ast is None and rows[0].rima == 3
    assert rows[0].players_in == "Berg, Ana" and rows[0].players_out is None
    stints = build.build(inputs, "matchup_stints").collect()
    assert rows[0].lineup_key == stints[0].home_lineup_key != rows[1].lineup_key


def test_event_features(inputs):
    rows = build.build(inputs, "pbp").collect()
    by = {r.event_description: r for r in rows if r.event_description}
    assert sum(c in rows[0].__fields__ for c in [*text.EVENT_FLAGS, *text.EVENT_EXTRACTS, "is_team_turnover"]) == 18
    made = by["2pt layup pointsinthepaint;fastbreak; made - GIA.HALE, assist"]
    assert made.is_paint and made.is_fastbreak and made.assist_player == "GIA.HALE" and made.ft_number is None
    turnover = by["turnover badpass team;"]
    assert turnover.is_team_turnover and turnover.turnover_type == "badpass"
    assert (by["freethrow 1of2 made"].ft_number, by["freethrow 1of2 made"].ft_attempts) == (1, 2)
    foul = by["foul personal shooting;2freethrow"]
    assert foul.foul_class == "personal" and foul.is_shooting_foul and foul.ft_awarded == 2
    assert by["headcoachchallenge foul accepted"].challenge_outcome == "accepted" and by["timeout short"].timeout_type == "short"
    assert all(getattr(r, f) is not None for r in rows for f in text.EVENT_FLAGS)
    assert [r.contest_id for r in rows] == ["101"] * 8 + ["102"]


def test_other_datasets(inputs):
    assert [tuple(r) for r in build.build(inputs, "schedule").collect()] == [("101", "01/07/2023", "Alder", "Birch St.", 9, 5, 2023), ("102", "01/09/2023", "Cedar", "Dogwood", 0, 4, 2023)]
    assert [tuple(r) for r in build.build(inputs, "rosters").collect()] == [(2023, None, None, 1), (2023, "Alder", "ANA.BERG", 2)]
    rosters = build.build(inputs, "team_rosters")
    assert rosters.schema.names == schemas.names(schemas.TEAM_ROSTERS)
    assert [(r.team_id, r.name, r.ht_inches) for r in rosters.collect()] == [("7", "Ames, Zoe", None), ("7", "Berg, Ana", 72)]
    assert [tuple(r) for r in build.build(inputs, "team_ids").collect()] == [("7", "Alder", 2023)]
    assert sorted(r.label for r in build.build(inputs, "shots").collect()) == ["7", "seven"]
    assert build.build(inputs, "possessions").count() == 0
    assert build.build(inputs, "team_box").count() == 2


def test_build_all_and_masters(spark, tree, inputs, tmp_path):
    base = str(tmp_path)
    assert inputs.skipped() == {"missing": 1, "failed": 1}
    counts = build.build_all(inputs, base, dry_run=True, repo="own/repo")
    assert counts["pbp"] == 9 and counts["possessions"] == 0 and not os.path.exists(f"{base}/wbb/possessions")
    again = build.build_season(inputs, "schedule", base)
    assert again.count() == 2
    manifest = source.read_manifest(spark, f"{base}/wbb/schedule/manifest.csv").collect()
    assert [(r.season, r.row_count) for r in manifest] == [(2023, 2)]
    files = publish.staged(registry.dataset("lineups"), 2023, base, "wbb")
    with gzip.open(files["csv.gz"], "rt") as f:
        assert len(f.read().splitlines()) == 5
    assert publish.built_seasons(registry.dataset("pbp"), base, "wbb") == {2023}
    paths = build.build_masters(spark, base, tree, "wbb")
    full = {r.contest_id: r for r in spark.read.parquet(paths[0]).collect()}
    assert len(full) == 6 and full["101"].in_pbp and full["101"].home_score == 9 and not full["105"].in_pbp and full["105"].home is None
    assert spark.read.parquet(paths[1]).count() == 3 - 1
    cover = {r.season: r for r in spark.read.parquet(paths[2]).collect()}
    assert cover[2023].n_games == 5 and cover[2023].pct_in_pbp == 0.4 and str(cover[2023].first_date) == "2023-01-07"
    inputs.release()


def test_writing_a_season_keeps_the_others(spark, tmp_path):
    d = registry.dataset("schedule")
    one = spark.createDataFrame([("1", 5)], "contest_id string, home_score long")
    for season, df in ((2022, one), (2023, one), (2023, one.union(one))):
        assert sinks.commit_season(df, d, season, str(tmp_path), "wbb") == df.count()
    got = source.read_committed(spark, str(tmp_path), "wbb", "schedule")
    assert dict(got.dtypes)["season"] == "bigint" and {r.season: r["count"] for r in got.groupBy("season").count().collect()} == {2022: 1, 2023: 2}
    target = str(tmp_path / "x" / "a.csv.gz")
    first = open(sinks.write_csv_gz(one, target, ["contest_id"]), "rb").read()
    assert open(sinks.write_csv_gz(one, target, ["contest_id"]), "rb").read() == first
    with pytest.raises(ValueError):
        sinks.write_csv_gz(one.withColumn("a", F.array(F.lit(1))), target, [])


def test_coverage_refuses_ids_that_are_no_text(spark):
    index = spark.createDataFrame([("1", "2023")], "contest_id string, season string")
    numbers = spark.createDataFrame([(1,)], "contest_id long")
    with pytest.raises(TypeError):
        coverage.build_index(index, {"pbp": numbers})
    with pytest.raises(FileNotFoundError):
        coverage.denominator(None)
    full = coverage.build_index(index, {})
    assert coverage.present_games(full).count() == 0 and full.columns[:2] == ["season", "contest_id"]


def test_name_signatures_and_keys(spark):
    pairs = [("O'Neil, Ana-Maria Jr.", "ANAMARIA.ONEIL"), ("Ångström, Zoë", "ZOE.ANGSTROM"), ("Day, A.J.", "AJ.DAY"), ("Lee III, Bo", "BO.LEE")]
    names = spark.createDataFrame([(n,) for p in pairs for n in p], "name string")
    got = {r.name: r.signature for r in text.name_signatures(names).collect()}
    assert all(got[a] == got[b] for a, b in pairs)
    assert text.season_label(2025) == "2024-25" and text.season_label(2000) == "1999-00"
    assert (text.human_size(10), text.human_size(2048), text.human_size(3 << 30)) == ("10 B", "2.0 KB", "3.0 GB")


def test_name_changes(spark, tmp_path):
    tree = str(tmp_path / "wbb" / "raw")
    G.write_bundles(tree)
    bundles = source.read_bundles(spark, tree, ["2023"])
    assert [tuple(r) for r in name_changes.changes(bundles).collect()] == [("2023", "Alder", "ZOE.SMITH", "ZOE.ANN'S", 2)]
    assert name_changes.unreadable(bundles).count() == 1
    assert source.read_bundles(spark, tree, ["2023"], limit=2).count() == 2
    run = lambda *a: cli.main(["name-changes", "--raw-root", str(tmp_path), "--out", str(tmp_path / "out"), *a])
    assert run("--season", "1999") == 2 and run() == 1 and spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_http_source(tmp_path):
    asked = []

    def get(url):
        asked.append(url)
        return {"http://x/wbb/json/1.json": b'{"a": 1}', "http://x/wbb/json/2.json": b"<html>"}.get(url)

    cache = str(tmp_path)
    assert http.fetch_cached("http://x/wbb/", "1", cache, get) == '{"a": 1}' == http.fetch_cached("http://x/wbb", "1", cache, get)
    assert http.fetch_cached("http://x/wbb", "2", cache, get) is None is http.fetch_cached("http://x/wbb", "3", cache, get)
    assert asked == [f"http://x/wbb/json/{i}.json" for i in (1, 2, 3)] and os.listdir(cache) == ["1.json"]
    assert source.resolve_root("http://x/wbb/") == "http://x/wbb"


def test_http_data_source_reads_from_its_cache(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"{i}.json").write_text(json.dumps({"contest_id": str(i)}))
    got = http.read_payloads(spark, "http://127.0.0.1:9", [str(i) for i in range(6)], cache=str(tmp_path), chunk=2).collect()
    assert {r.contest_id: r.payload is not None for r in got} == {**{str(i): True for i in range(5)}, "5": False}


def test_a_season_reads_only_its_own_files(spark, tree):
    one = build.Season(spark, 2023, tree, "wbb")
    assert one.skipped() == {"missing": 1, "failed": 1}
    assert sorted(os.path.basename(f) for f in one.payloads.texts.inputFiles()) == ["101.json", "102.json", "103.json", "104.json"]
    one.release()
    assert build.Season(spark, 1999, tree, "wbb").games is None


def test_a_season_from_an_http_root_is_that_of_the_files(spark, tree, inputs, tmp_path):
    import functools
    import shutil
    import threading
    from http.server import SimpleHTTPRequestHandler, ThreadingHTTPServer

    root = tmp_path / "wbb"
    shutil.copytree(f"{tree}/wbb/json", root / "json")
    shutil.copy(next(p for p in os.scandir(f"{tree}/wbb/schedule_master.parquet") if p.name.startswith("part-")).path, root / "schedule_master.parquet")

    class Quiet(SimpleHTTPRequestHandler):
        def log_message(self, *a):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(Quiet, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        there = build.Season(spark, 2023, f"http://127.0.0.1:{server.server_port}/wbb/", "wbb")
        for name in ("pbp", "schedule", "rosters", "matchup_stints", "lineups", "shots"):
            a, b = build.build(there, name), build.build(inputs, name)
            assert sorted(a.columns) == sorted(b.columns) and sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect())), name
        assert there.skipped() == {"missing": 2, "failed": 0}  # a malformed body counts as none
    finally:
        server.shutdown()


def test_case_folding_and_page_patterns(spark):
    letters = [chr(c) for c in [*range(0x20, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x2000), *range(0xFB00, 0xFB07)] if chr(c).isprintable()]
    df = spark.createDataFrame([(f"a{c}b",) for c in letters], "t string")
    wrong = [r.t for r in df.select("t", text.case_folded(F.col("t")).alias("f")).collect() if r.f != r.t.casefold()]
    assert len(wrong) <= 0.02 * len(letters) and "aßb" not in wrong and "aςb" not in wrong and "aıb" not in wrong
    page = """<option value="12" selected> A  B </option><OPTION data-x='1' value='7'>C</OPTION><option value=9>D</option><option value="x">no</option><option value="5"></option>
    addShot(3, "l: made by Ana Berg(Alder) a player_12 b"); addShot (4,"(a)"); addShot("l: missed by Zoe (Birch St.) player_7"); addShot("l: blocked by No(One) player_8")"""
    pages_of = spark.createDataFrame([(1, page), (2, None), (3, "")], "file long, p string")
    r = pages_of.select(text.option_pairs(F.col("p")).alias("o")).first()
    assert [tuple(x) for x in r.o] == [("12", "A  B"), ("7", "C"), ("9", "D")] == list(pages.options(page))
    found = pages.walk(pages_of, ["file"], "p").collect()
    assert {r.file for r in found} == {1}
    assert [(r.name.strip(), r.team, r.pid) for r in found if r.kind == "shot"] == [("Ana Berg", "Alder", "12"), ("Zoe", "Birch St.", "7")]
    assert [(r.pid, r.name, r.team) for r in found if r.kind == "option"] == [("12", "A  B", None), ("7", "C", None), ("9", "D", None)]


def test_shots_of_invented_pages():
    """Calls with nested parentheses, other colons, no id, an id of another call, and no end."""
    shots = lambda page: list(pages.shots(page))
    assert shots('addShot(1, "q: 3: made by Ana Berg(Alder) x player_1")') == [("Ana Berg", "Alder", "1")]
    assert shots('addShot(f(1), "made by Ana(Alder) player_1")') == []
    assert shots('addShot("q: made by Ana(Alder (N)) player_1")') == []
    assert shots('addShot("q: made by Ana(Alder) nothing"); addShot("q: missed by Bo(Birch) player_2 player_3")') == [("Bo", "Birch", "2")]
    assert shots('addShot("q: made by Ana(Alder) player_ player_x player_44b") addShot("q: made by Ana(Alder) player_5') == [("Ana", "Alder", "44"), ("Ana", "Alder", "5")]
    assert shots('addShot("q: saved by Ana(Alder) player_1"); addShot "q: made by Ana(Alder) player_1"; addShot("q: made by (Alder) player_1"); addShot("q: made by Ana() player_1")') == []
    assert shots("") == [] and shots('addShot("q: made by Ana') == []


def test_folding_to_ascii_is_the_decomposition(spark):
    letters = [chr(c) for c in (*range(1, 0xD800), *range(0xE000, 0x30000)) if unicodedata.category(chr(c)) != "Cn"]
    df = spark.createDataFrame([(f"A{c}z",) for c in letters], "t string").repartition(8)
    want = lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().casefold()
    assert [r.t for r in df.select("t", text.ascii_fold(F.col("t")).alias("f")).collect() if r.f != want(r.t)] == []


def test_python_and_scans_of_plans(spark, sf_dir):
    """Names are folded without Python, stints are made from two scans of the events, and pages are walked once."""
    plan = lambda name: game_queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan("season_lineups") + plan("season_matchup_stints") and "Arrow" not in plan("season_lineups") + plan("season_matchup_stints")
    assert plan("season_matchup_stints").count("Scan parquet") <= 3
    assert plan("player_name_changes").count("MapInArrow") == 1 and "ArrowEval" not in plan("player_name_changes")


def test_publishing(tmp_path):
    d, calls = registry.dataset("pbp"), []
    files = publish.staged(d, 2023, str(tmp_path), "wbb")
    os.makedirs(os.path.dirname(files["parquet"]))
    for kind in ("parquet", "csv.gz"):
        open(files[kind], "w").close()

    def no_rds(parquet, rds):
        raise RuntimeError("no R")

    out = publish.publish(d, 2023, str(tmp_path), "wbb", "own/repo", runner=calls.append, exists=lambda t, r: False, make_rds=no_rds)
    assert out["uploaded"] == 2 and [c[1] for c in calls] == ["create", "upload", "upload"]
    assert publish.publish(d, 2023, str(tmp_path), "wbb", "own/repo", dry_run=True, runner=calls.append, make_rds=None)["uploaded"] == 0

    def absent(args):
        raise RuntimeError("release not found")

    def down(args):
        raise RuntimeError("timeout")

    assert publish.list_assets("t", "r", absent) is None and publish.list_assets("t", "r", lambda a: "a.parquet\nb.csv.gz") == {"a.parquet", "b.csv.gz"}
    with pytest.raises(publish.ListingUnavailable):
        publish.list_assets("t", "r", down)
    assert publish.release_exists("t", "r", lambda t, r: publish.list_assets(t, r, down)) is True
    assert publish.complete_seasons(["pbp_2023.parquet", "pbp_2023.csv.gz", "pbp_2022.parquet", "x"], "pbp") == {2023}
    assert publish.audit({1, 2}, {2, 3}) == ([1], [3]) and publish.pending_units([("a", 1), ("b", 1)], {("a", 1)}) == [("b", 1)]


def test_cli_codes(tmp_path):
    args = cli.parser().parse_args(["check", "--dataset", "pbp", "--base", str(tmp_path), "--repo", "r"])
    os.makedirs(tmp_path / "wbb" / "pbp" / "parquet" / "season=2023")

    def down(tag, repo):
        raise publish.ListingUnavailable("x")

    assert cli.run_check(args, lambda t, r: {"pbp_2023.parquet", "pbp_2023.csv.gz"}) == 0
    assert cli.run_check(args, lambda t, r: None) == 1
    assert cli.run_check(args, down) == 2
    assert cli.main([]) == 2
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["build", "--dataset", "pbp", "--season", "2023", "--publish", "--dry-run"])


def test_sweep_builds_what_is_missing_and_goes_on_after_failures():
    args = cli.parser().parse_args(["sweep", "--first", "2022", "--last", "2023", "--repo", "r"])
    live = lambda tag, repo: {f"{tag}_2023.parquet", f"{tag}_2023.csv.gz"} if tag != "pbp" else None
    built = []

    def unit(args, name, season):
        built.append((name, season))
        if name == "shots":
            raise RuntimeError("x")

    assert cli.run_sweep(args, live, unit) == 1
    assert built[0] == ("pbp", 2023) and len(built) == 1 + len(registry.CATALOG) and built[-1] == ("shots", 2022)

    def down(tag, repo):
        raise publish.ListingUnavailable("x")

    assert cli.run_sweep(args, down, unit) == 2


def test_streams_run_the_same_plans(spark, tree, tmp_path, sf_dir):
    schema = source.Payloads(source.payload_texts(spark, f"{tree}/wbb/json")).schema
    query = arrivals.append_families(arrivals.stream_games(spark, f"{tree}/wbb/json", schema), 2023, str(tmp_path / "out"), str(tmp_path / "ck"), {"schedule": datasets.schedule})
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "schedule")).count() == 3
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stamped = spark.readStream.schema(events.schema).parquet(f"{sf_dir}/events.parq*").withColumn("ts", F.col("ts").cast("timestamp"))
    query = arrivals.windowed_counts(stamped).writeStream.outputMode("complete").format("memory").queryName("hourly").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("hourly").agg(F.sum("n")).first()[0] == events.count()


def test_ordering_a_dataset_does_not_make_its_rows_twice(spark):
    from pyspark.sql import functions as F

    from loomline.plans import datasets

    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(n):
        made.add(1)
        return n

    rows = spark.range(0, 500, 1, 4).select(F.col("id").cast("string").alias("contest_id"), seen((500 - F.col("id"))).alias("_pos"))
    got = datasets.in_order(rows, "_pos", "contest_id").collect()
    assert [r["_pos"] for r in got] == list(range(1, 501))
    assert made.value == 500


def test_names_lose_suffixes_only_as_words_of_their_own(spark):
    from pyspark.sql import functions as F

    from loomline.functions import text

    names = ["Iva Vii", "JR Smith III", "O'jr", "V.V.", "sr", "", "'", "Núñez, Jr.", "Ivy-iv-v'", "ⅳ x", "á ií"]
    got = [r[0] for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i").select(text.signature(F.col("n"))).collect()]

    def plain(name):
        import re
        import unicodedata

        folded = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
        return "".join(sorted("".join(t for t in re.split(r"[^a-z0-9']+", folded) if t not in text.NAME_SUFFIXES).replace("'", "")))

    assert got == [plain(n) for n in names]


def test_lineups_of_stints_makes_no_pairs(spark, tmp_path, sf_dir):
    import duckdb
    from pyspark.sql import functions as F

    from loomline.plans import game_queries

    # One contest with all events, and one with a few.
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("user_id", F.when(F.col("event_id") % 50 == 0, F.lit(5)).otherwise(F.lit(2)).cast("long"))
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    got = game_queries.lineups_of_stints(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.execute(game_queries.ORACLES["lineups_of_stints"])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(want.fetchall())
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(plan) if "Join " in line)
    assert not any("Aggregate" in line for line in plan[:join])


def test_a_lineup_key_is_tested_for_null_without_being_made(spark):
    from pyspark.sql import functions as F

    from loomline.functions import text

    rows = spark.createDataFrame([(0, "Alder", ["A B"]), (1, "", ["A B"]), (2, None, ["A B"]), (3, "Alder", []), (4, "Alder", None), (5, " ", [None])], "i int, team string, players array<string>")
    keyed = text.add_lineup_keys(rows, {"key": ("team", "players")}).where("key is not null")
    assert sorted(r["i"] for r in keyed.collect()) == [0, 5]
    plan = keyed.select("i")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "md5" not in plan


def test_signatures_drop_every_character_that_is_no_letter_or_digit(spark):
    from pyspark.sql import functions as F

    from loomline.functions import text

    names = ["".join(map(chr, range(0x80))), "a\x00b", "a\tb\x7fc", "A'b-c.d_e", "Vii\x01b", "Núñez\x00 II", "İ ß", "Kelvin K", ""]
    got = [r[0] for r in spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i").select(text.signature(F.col("n"))).collect()]

    def plain(name):
        import re
        import unicodedata

        folded = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
        return "".join(sorted("".join(t for t in re.split(r"[^a-z0-9']+", folded) if t not in text.NAME_SUFFIXES).replace("'", "")))

    assert got == [plain(n) for n in names]
