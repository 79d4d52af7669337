"""Queries that run the season builders on payloads made of the driver's tables, each beside its SQL oracle.

A game is a user of ``events``; its play-by-play are the user's events in order of time. The
columns of those rows are SQL expressions that Spark and the oracle both evaluate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomline import schemas
from loomline.functions import nested, text
from loomline.operators import relational
from loomline.plans import coverage, datasets, name_changes, sweep
from loomline.sources import games as games_source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SEASON = 2024


def query(oracle: str):
    def register(build):
        QUERIES[build.__name__] = build
        ORACLES[build.__name__] = oracle
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DESCRIPTIONS = [
    "2pt layup pointsinthepaint;fastbreak; made - GIA.HALE, assist", "freethrow 1of2 made", "foul personal shooting;2freethrow", "turnover badpass team;", "timeout short",
    "headcoachchallenge call accepted", "foul technical classb looseball", "2ndchance fromturnover oneandone flagrant", "foul adminTechnical benchclassb", "turnover lostball",
]
FIRST = ["ANA.BERG", "Bea O'Neil Jr.", "CIA.DUNN", "Zoë Ann", "Núñez, Eva", "GIA.HALE III", "IDA JOHN"]


def picked(index: str, values: list[str]) -> str:
    """A CASE expression of the value at an index."""
    quoted = ["'" + v.replace("'", "''") + "'" for v in values]
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(quoted)) + " END"


def player(side: int, slot: int) -> str:
    """Who stands in a slot: two of five change from day to day, and some rows lack the first."""
    change = "+ day(ts) % 2" if slot in (2, 4) else ""
    name = picked(f"((user_id + {3 * side + slot} {change}) % {len(FIRST)})", [f"{n} {side}{slot}" for n in FIRST])
    return f"CASE WHEN event_id % 17 = {slot} THEN NULL ELSE {name} END" if slot == 1 else name


EVENT = {
    "contest_id": "CAST(user_id AS VARCHAR(20))",
    "event_id": "event_id",
    "period": "CAST(1 + day(ts) % 3 AS BIGINT)",
    "game_seconds": "CAST(minute(ts) * 60 + hour(ts) AS BIGINT)",
    "home_score": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 97 AS BIGINT) END",
    "away_score": "CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(event_id % 89 AS BIGINT) END",
    "home": "CASE WHEN user_id % 2 = 0 THEN 'Alder  State' ELSE 'Groß Birch' END",
    "away": "CASE WHEN user_id % 3 = 0 THEN 'Cedar' ELSE 'Dogwood St.' END",
    "game_date": "CASE user_id % 3 WHEN 0 THEN '01/07/2024' WHEN 1 THEN '12/31/2023' ELSE 'soon' END",
    "poss_num": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 4 AS BIGINT) END",
    "event_description": f"CASE WHEN event_id % 13 = 0 THEN NULL ELSE {picked(f'(event_id % {len(DESCRIPTIONS)})', DESCRIPTIONS)} END",
    **{f"{side}_{i}": player(k, i) for k, side in enumerate(("home", "away")) for i in range(1, 6)},
}
EV = f"ev AS (SELECT {', '.join(f'{e} AS {n}' for n, e in EVENT.items())}, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events)"


def filled(values: dict[str, str], kind: T.StructType, at: str = "") -> str:
    """A named_struct of the type: expressions by dotted path, nulls elsewhere."""
    fields = []
    for f in kind:
        path, name = at + f.name, f.dataType.simpleString()
        inner = path not in values and any(p.startswith(f"{path}.") for p in values)
        fields.append(f"'{f.name}', " + (filled(values, f.dataType, f"{path}.") if inner else f"CAST({values.get(path, 'NULL')} AS {name})"))
    return f"named_struct({', '.join(fields)})"


def people(*names: str) -> str:
    """An array of a lineup's players, by expressions of their names."""
    return "array(" + ", ".join(f"named_struct('code', CAST(NULL AS STRING), 'id', named_struct('name', {n}))" for n in names) + ")"


def side(values: dict[str, str], where: str) -> str:
    """The statistics of a side that is there on some rows."""
    return f"CASE WHEN {where} THEN {filled(values, schemas.struct(schemas.SIDE_STATS))} END"


def gathered(rows: DataFrame, columns: list[str], name: str) -> DataFrame:
    """(contest_id, _cid, name): each game's rows in order of time, which they carry."""
    # Rows are made before the exchange, in compiled code; within the aggregate they would be interpreted, and nothing is gained by gathering twice.
    made = rows.select("contest_id", F.struct("ts", "event_id", *columns).alias("e")).repartition("contest_id")
    return made.groupBy("contest_id").agg(F.sort_array(F.collect_list("e")).alias(name)).withColumn("_cid", F.col("contest_id"))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("ts", "user_id", *[f"{e} AS {n}" for n, e in EVENT.items()])


def games(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Payloads with play-by-play; of an event only the columns asked for are gathered."""
    return gathered(event_rows(spark, sf_dir), columns or [n for n in EVENT if n not in ("contest_id", "event_id")], "pbp")


def box_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with box rows of the first two slots."""
    pair = lambda x: F.array(*[F.struct(x["home"].alias("team"), x[f"home_{i}"].alias("player")) for i in (1, 2)])
    return gathered(event_rows(spark, sf_dir), ["home", "home_1", "home_2"], "r").select("contest_id", "_cid", F.flatten(F.transform("r", pair)).alias("player_box"))


def lineup_games(spark: SparkSession, sf_dir: str, values: dict[str, str]) -> DataFrame:
    """Payloads with nested lineups of every fifth event, by the expressions of their values."""
    lineup = F.expr(filled(values, schemas.struct(f"x {schemas.LINEUP}")["x"].dataType))
    # Games without such events have no lineups, and so no rows either way.
    rows = event_rows(spark, sf_dir).where("event_id % 5 = 0").select("contest_id", "ts", "event_id", lineup.alias("lineup"))
    return gathered(rows, ["lineup.*"], "lineups")


def flag_sql(needle: str) -> str:
    return f"coalesce(contains(event_description, '{needle}'), false)"


def extract_sql(pattern: str, kind: str) -> str:
    found = f"nullif(regexp_extract(event_description, '{pattern.removeprefix('(?U)')}', 1), '')"
    return f"CAST({found} AS BIGINT)" if kind == "bigint" else found


@query(f"""WITH {EV} SELECT contest_id, CAST({SEASON} AS BIGINT) AS season, event_id, period, game_seconds, home_score, home_1, away_5,
  {", ".join(f"{flag_sql(needle)} AS {name}" for name, needle in text.EVENT_FLAGS.items())}, {", ".join(f"{extract_sql(*p)} AS {name}" for name, p in text.EVENT_EXTRACTS.items())},
  {flag_sql("turnover")} AND {flag_sql(" team;")} AS is_team_turnover FROM ev""")
def season_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The play-by-play dataset with its eighteen event features."""
    rows = datasets.family(games(spark, sf_dir), "pbp", SEASON)
    return rows.select("contest_id", "season", "event_id", "period", "game_seconds", "home_score", "home_1", "away_5", *text.EVENT_FLAGS, *text.EVENT_EXTRACTS, "is_team_turnover")


@query(f"""WITH {EV} SELECT contest_id, arg_min(game_date, pos) AS game_date, arg_min(home, pos) AS home, arg_min(away, pos) AS away,
  max(coalesce(home_score, 0)) AS home_score, max(coalesce(away_score, 0)) AS away_score, CAST({SEASON} AS BIGINT) AS season FROM ev GROUP BY contest_id""")
def season_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schedule dataset."""
    return datasets.schedule(games(spark, sf_dir, ["game_date", "home", "away", "home_score", "away_score"]), SEASON)


@query(f"""WITH {EV} SELECT CAST({SEASON} AS BIGINT) AS season, team, player, count(DISTINCT contest_id) AS games FROM (
  SELECT contest_id, home AS team, home_1 AS player FROM ev UNION ALL SELECT contest_id, home, home_2 FROM ev) GROUP BY team, player""")
def season_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rosters dataset."""
    return datasets.rosters(box_games(spark, sf_dir), SEASON)


def signature_sql(name: str) -> str:
    """A name's sorted letters without accents, suffixes and punctuation."""
    tokens = f"regexp_split_to_array(lower(strip_accents({name})), '[^a-z0-9'']+')"
    return f"array_to_string(list_sort(string_split(replace(array_to_string(list_filter({tokens}, lambda t: t NOT IN ('jr','sr','ii','iii','iv','v')), ''), '''', ''), '')), '')"


def key_sql(team: str, names: str) -> str:
    norm = f"replace(lower(trim(regexp_replace({team}, '\\s+', ' ', 'g'))), 'ß', 'ss')"
    signed = f"array_to_string(list_sort(list_transform({names}, lambda n: {signature_sql('n')})), '|')"
    return f"substr(md5({norm} || '|' || {signed}), 1, 16)"


def five(side: str) -> str:
    return "list_sort([" + ", ".join(f"{side}_{i}" for i in range(1, 6)) + "])"


ON_COURT = " AND ".join(f"{side}_{i} IS NOT NULL" for side in ("home", "away") for i in range(1, 6))
STINTS = f"""WITH {EV},
usable AS (SELECT *, {five("home")} AS hl, {five("away")} AS al FROM ev WHERE {ON_COURT} AND contest_id IN (
  SELECT contest_id FROM ev GROUP BY 1 HAVING count(period) > 0 AND count(game_seconds) > 0 AND count(home_score) > 0 AND count(away_score) > 0)),
marked AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR hl <> lag(hl) OVER w OR al <> lag(al) OVER w OR period <> lag(period) OVER w THEN 1 ELSE 0 END AS brk
  FROM usable WINDOW w AS (PARTITION BY contest_id ORDER BY pos)),
numbered AS (SELECT *, CAST(sum(brk) OVER (PARTITION BY contest_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS game_stint_num FROM marked),
runs AS (SELECT contest_id, game_stint_num, first(home ORDER BY pos) AS home, first(away ORDER BY pos) AS away, first(period ORDER BY pos) AS period, first(hl ORDER BY pos) AS hl, first(al ORDER BY pos) AS al,
    first(game_seconds ORDER BY pos) AS start_seconds, last(game_seconds ORDER BY pos) AS end_seconds, last(home_score ORDER BY pos) AS end_home_score, last(away_score ORDER BY pos) AS end_away_score,
    count(DISTINCT poss_num) AS n_possessions, count(*) AS n_events FROM numbered GROUP BY ALL),
keyed AS (SELECT *, {key_sql("home", "hl")} AS home_lineup_key, {key_sql("away", "al")} AS away_lineup_key FROM runs)
SELECT contest_id, game_stint_num, home, away, period, array_to_string(hl, '|') AS home_lineup, hl[1] AS home_1, al[5] AS away_5, start_seconds, end_seconds, end_seconds - start_seconds AS duration_seconds,
  end_home_score - lag(end_home_score, 1, 0) OVER s AS home_pts, end_away_score - lag(end_away_score, 1, 0) OVER s AS away_pts, n_possessions, n_events,
  home_lineup_key, away_lineup_key, home_lineup_key || '_' || away_lineup_key AS matchup_key FROM keyed WINDOW s AS (PARTITION BY contest_id ORDER BY game_stint_num)"""


@query(STINTS)
def season_matchup_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matchup stints dataset, with its lineup keys."""
    stints = datasets.matchup_stints(games(spark, sf_dir, datasets.STINT_COLUMNS), SEASON)
    return stints.select("contest_id", "game_stint_num", "home", "away", "period", "home_lineup", "home_1", "away_5", "start_seconds", "end_seconds", "duration_seconds", "home_pts", "away_pts", "n_possessions", "n_events", "home_lineup_key", "away_lineup_key", "matchup_key")


#: What stands where in a nested lineup of ``season_lineups``, by an event's columns.
LINEUP_VALUES = {
    "date": "game_date", "start_min": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 40 AS DOUBLE) END", "end_min": "event_id", "team.team.name": "home", "team.year.value": "2024", "opponent.team.name": "away", "lineup_id.value": "'L'",
    "players": people(*[f"home_{i}" for i in range(1, 6)], "''"), "players_in": people("home_2", "CAST(NULL AS STRING)"), "players_out": people("''"), "score_info.start.scored": "home_score",
    "team_stats.num_possessions": "event_id % 9", "team_stats.fg.attempts.total": "event_id % 5", "team_stats.fg.made.total": "event_id % 3", "team_stats.fg.ast.total": "1", "team_stats.orb.total": "event_id % 6",
    "team_stats.fg_3p.attempts.total": "event_id % 4", "team_stats.fg_3p.made.total": "event_id % 2", "team_stats.fg_3p.ast.total": "event_id % 2",
}
NAMES = "list_sort(list_filter([home_1, home_2, home_3, home_4, home_5], lambda n: n IS NOT NULL))"


@query(f"""WITH {EV}, rows AS (SELECT *, {NAMES} AS names, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 40 AS DOUBLE) END AS start_min FROM ev WHERE event_id % 5 = 0)
SELECT contest_id, CAST({SEASON} AS BIGINT) AS season, {key_sql("home", "names")} AS lineup_key,
  CASE WHEN start_min IS NOT NULL THEN row_number() OVER (PARTITION BY contest_id, home ORDER BY start_min NULLS LAST, pos) END AS stint_num, home AS team, away AS opponent, start_min, CAST(event_id AS DOUBLE) AS end_min,
  names[1] AS player_1, names[5] AS player_5, home_2 AS players_in, CAST(NULL AS VARCHAR) AS players_out, home_score AS start_scored, event_id % 9 AS poss, event_id % 5 AS fga, event_id % 3 AS fgm, event_id % 2 AS tp_ast, event_id % 6 AS orb,
  CAST(NULL AS BIGINT) AS stl, CASE WHEN event_id % 2 = 0 THEN event_id % 50 END AS opp_pts, CASE WHEN event_id % 2 = 0 THEN event_id % 8 END AS opp_ast FROM rows""")
def season_lineups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineups dataset: nested stints as flat rows with keys and ranks."""
    opponent = side({"pts": "event_id % 50", "assist.total": "event_id % 8"}, "event_id % 2 = 0")
    rows = datasets.family(lineup_games(spark, sf_dir, LINEUP_VALUES | {"opponent_stats": opponent}), "lineups", SEASON)
    return rows.select("contest_id", "season", "lineup_key", "stint_num", "team", "opponent", "start_min", "end_min", "player_1", "player_5", "players_in", "players_out", "start_scored", "poss", "fga", "fgm", "tp_ast", "orb", "stl", "opp_pts", "opp_ast")


#: Where each column of a flat lineup comes from in the nested one, and its value by an event's columns.
WIDE_VALUES = {
    "date": "game_date", "location_type": "CASE event_id % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'away' END", "start_min": "CAST(event_id % 40 AS DOUBLE)", "end_min": "CAST(event_id % 40 + 2 AS DOUBLE)",
    "duration_mins": "CAST(2 AS DOUBLE)", "team.team.name": "home", "team.year.value": "CAST(2020 + event_id % 5 AS BIGINT)", "opponent.team.name": "away", "lineup_id.value": "CASE WHEN event_id % 7 > 0 THEN 'L' || CAST(event_id AS VARCHAR(20)) END",
    "score_info.start.scored": "home_score", "score_info.start.allowed": "away_score", "score_info.end.scored": "home_score + 2", "score_info.end.allowed": "away_score + 1",
    "score_info.start_diff": "home_score - away_score", "score_info.end_diff": "CAST(event_id % 23 AS BIGINT) - 11", "player_count_error": "CASE WHEN event_id % 4 = 0 THEN CAST(1 AS BIGINT) END",
}
SIDE_VALUES = {prefix: {path: f"CAST((event_id * {a + k} + {k}) % {m + k % 7} AS BIGINT)" for k, path in enumerate(nested.STATS.values())} for prefix, a, m in (("team_stats", 3, 5), ("opponent_stats", 4, 6))}
FLAT_LINEUP = {
    "date": "date", "location_type": "location_type", "team": "team.team.name", "team_year": "team.year.value", "opponent": "opponent.team.name", "lineup_id": "lineup_id.value", "start_min": "start_min", "end_min": "end_min", "duration_mins": "duration_mins",
    "start_scored": "score_info.start.scored", "start_allowed": "score_info.start.allowed", "end_scored": "score_info.end.scored", "end_allowed": "score_info.end.allowed", "start_diff": "score_info.start_diff", "end_diff": "score_info.end_diff", "player_count_error": "player_count_error",
}


WIDE = {
    **{name: WIDE_VALUES[path] for name, path in FLAT_LINEUP.items()},
    **{name: SIDE_VALUES["team_stats"][path] for name, path in nested.STATS.items()},
    **{f"opp_{name}": f"CASE WHEN event_id % 2 = 0 THEN {SIDE_VALUES['opponent_stats'][path]} END" for name, path in nested.STATS.items()},
    **{f"player_{i}": f"names[{i}]" for i in range(1, 6)},
    "players_in": "CASE WHEN event_id % 6 < 3 THEN concat_ws(' | ', home_2, home_4) END", "players_out": "home_5",
}


@query(f"""WITH {EV}, rows AS (SELECT *, {NAMES} AS names FROM ev WHERE event_id % 5 = 0)
SELECT contest_id, CAST({SEASON} AS BIGINT) AS season, {key_sql("home", "names")} AS lineup_key, row_number() OVER (PARTITION BY contest_id, home ORDER BY event_id % 40, pos) AS stint_num, {", ".join(f"{e} AS {n}" for n, e in WIDE.items())} FROM rows""")
def season_lineups_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 77 columns of the lineups dataset, from stints of which every statistic is set."""
    stint = WIDE_VALUES | {f"team_stats.{path}": value for path, value in SIDE_VALUES["team_stats"].items()} | {
        "players": people(*[f"home_{i}" for i in range(1, 6)]), "players_in": f"CASE WHEN event_id % 6 < 3 THEN {people('home_2', 'home_4')} END", "players_out": people("''", "home_5"),
        "opponent_stats": side(SIDE_VALUES["opponent_stats"], "event_id % 2 = 0"),
    }
    return datasets.family(lineup_games(spark, sf_dir, stint), "lineups", SEASON)


def coverage_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coverage index of contests that are orders, with committed datasets drawn from lines and events."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    index = orders.select(F.col("o_orderkey").cast("string").alias("contest_id"), F.year("o_orderdate").cast("string").alias("season"))
    ids = lambda where: lines.where(where).select(F.col("l_orderkey").cast("string").alias("contest_id"))
    built = orders.where("o_orderkey % 3 = 0").select(
        F.year("o_orderdate").cast("long").alias("season"), F.col("o_orderkey").cast("string").alias("contest_id"), F.date_format("o_orderdate", "MM/dd/yyyy").alias("game_date"),
        F.col("o_orderpriority").alias("home"), F.col("o_orderstatus").alias("away"), F.col("o_custkey").alias("home_score"), F.lit(None).cast("bigint").alias("away_score"),
    )
    return coverage.build_index(index.union(index), {"schedule": built.union(built), "pbp": ids("l_quantity > 25"), "shots": ids("l_returnflag = 'R'")})


FLAGS = ["pbp", "schedule", "shots"]
INDEX = """full_index AS (SELECT CAST(year(o_orderdate) AS BIGINT) AS season, CAST(o_orderkey AS VARCHAR) AS contest_id, o_orderkey % 3 = 0 AS in_schedule,
  o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 25) AS in_pbp, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS in_shots,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%m/%d/%Y') END AS game_date, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS home, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS home_score FROM orders)"""


@query(f"WITH {INDEX} SELECT *, false AS in_lineups FROM full_index")
def coverage_index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The coverage index: a flag per dataset, and the detail of built games."""
    return coverage_index(spark, sf_dir).select("season", "contest_id", "in_schedule", "in_pbp", "in_shots", "in_lineups", "game_date", "home", "home_score")


@query(f"WITH {INDEX} SELECT season, contest_id FROM full_index WHERE in_schedule OR in_pbp OR in_shots")
def coverage_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contests that any dataset holds."""
    return coverage.present_games(coverage_index(spark, sf_dir)).select("season", "contest_id")


@query(f"""WITH {INDEX} SELECT season, count(*) AS n_games, CAST(min(strptime(game_date, '%m/%d/%Y')) AS DATE) AS first_date, CAST(max(strptime(game_date, '%m/%d/%Y')) AS DATE) AS last_date,
  {", ".join(f"round(avg(CASE WHEN in_{f} THEN 1 ELSE 0 END), 9) AS pct_in_{f}" for f in FLAGS)} FROM full_index GROUP BY season""")
def coverage_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage per season."""
    return coverage.coverage(coverage_index(spark, sf_dir)).select("season", "n_games", "first_date", "last_date", *[F.round(f"pct_in_{f}", 9).alias(f"pct_in_{f}") for f in FLAGS])


@query(f"WITH {INDEX} SELECT {', '.join(f'CAST(count(*) FILTER (in_{f}) AS BIGINT) AS in_{f}' for f in FLAGS)} FROM full_index")
def coverage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many contests each dataset holds."""
    return coverage.flag_totals(coverage_index(spark, sf_dir)).select(*[f"in_{f}" for f in FLAGS])


@query("""SELECT '2024' AS season, team, was AS name_game_time, now AS name_current, count(*) AS n_games FROM (
  SELECT c_mktsegment AS team, 'PLAYER.' || (c_custkey % 5) AS was, 'PLÁYER.' || (c_custkey % 3) AS now_raw, 'PLAYER.' || (c_custkey % 3) AS now FROM customer) WHERE was <> now GROUP BY ALL""")
def player_name_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players renamed since the game, from pages with a list of options and a script of shots; a customer is a page."""
    page = F.concat(
        F.lit('<select><option value="1">Old  Pick</option><option selected value="1"> Pl&aacute;yer '), F.col("c_custkey") % 3, F.lit("</option><option value='2'>Same</option></select><script>"),
        F.lit('addShot(1, 2, "left: made by Player  '), F.col("c_custkey") % 5, F.lit("("), F.col("c_mktsegment"), F.lit(' ) a player_1 b"); addShot(1, "x: missed by Same(X) player_2"); addShot(2, "y: missed by Nobody(X) player_3")</script>'),
    )
    bundles = table(spark, sf_dir, "customer").select(F.lit("2024").alias("season"), F.col("c_custkey").cast("string").alias("file"), page.alias("box_score"), (F.col("c_custkey") < 0).alias("corrupt"))
    return name_changes.changes(bundles)


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS team, CAST(2024 AS BIGINT) AS season FROM supplier WHERE s_nationkey % 2 = 0""")
def season_team_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A season's rows of a crosswalk."""
    label = F.when(F.col("s_nationkey") % 2 == 0, F.lit("2023-24")).otherwise(F.lit("2022-23"))
    return datasets.team_ids(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("team"), label.alias("season")), SEASON)


@query("""SELECT coalesce(CASE WHEN n_nationkey % 4 > 0 THEN CAST(n_nationkey AS VARCHAR) END, 'None') AS team_id, n_name AS team, c_name AS name, CAST(c_custkey AS VARCHAR) AS player_id,
  CAST(2024 AS BIGINT) AS season FROM nation JOIN customer ON c_nationkey = n_nationkey""")
def season_team_rosters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players of roster files; a nation is a team."""
    fields = {**{f: F.lit(None).cast("string") for f in schemas.ROSTER_PLAYER_FIELDS}, "name": F.col("c_name"), "ht_inches": F.lit(None).cast("bigint"), "player_id": F.col("c_custkey").cast("string")}
    players = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.collect_list(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("players"))
    files = table(spark, sf_dir, "nation").join(players, F.col("c_nationkey") == F.col("n_nationkey"))
    files = files.select(F.when(F.col("n_nationkey") % 4 > 0, F.col("n_nationkey").cast("string")).alias("team_id"), F.col("n_name").alias("team"), "players")
    return datasets.team_rosters(files, SEASON).select("team_id", "team", "name", "player_id", "season")


@query("SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS contest_id FROM orders WHERE year(o_orderdate) = 1996")
def season_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contests of a season by the index, in which an order is a contest twice."""
    index = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("contest_id"), F.year("o_orderdate").cast("string").alias("season"))
    return games_source.season_ids(index.union(index), 1996)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS contest_id, false AS found FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber < 3)
  UNION ALL SELECT DISTINCT CAST(l_orderkey AS VARCHAR), true FROM lineitem WHERE l_linenumber < 3 AND l_orderkey IN (SELECT o_orderkey FROM orders)""")
def index_and_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contests of the index with and without a payload file; an order with a line of a low number has one."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("contest_id"))
    files = table(spark, sf_dir, "lineitem").where("l_linenumber < 3").select(F.col("l_orderkey").cast("string").alias("_cid")).distinct()
    found, missing = games_source.split_by_presence(files, ids)
    return found.select(F.col("_cid").alias("contest_id"), F.lit(True).alias("found")).unionByName(missing.select("contest_id", F.lit(False).alias("found")))


@query("""SELECT CAST(user_id AS VARCHAR) AS contest_id, CAST(2024 AS BIGINT) AS season, event_id, CASE WHEN user_id % 2 = 0 THEN CAST(event_id % 9 AS VARCHAR) ELSE 'L' || event_id % 8 END AS label,
  CASE WHEN user_id % 5 = 0 THEN event_id % 7 END AS extra, CASE WHEN event_id % 6 > 0 THEN event_id % 4 END AS period, round(CASE WHEN event_id % 3 = 0 THEN event_id ELSE event_id + 0.5 END, 3)::DOUBLE AS clock FROM events WHERE user_id % 10 <> 3""")
def payload_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of payload texts whose columns differ in presence and type from game to game; a tenth of the texts are cut off."""
    event = lambda label, more="": f"to_json(named_struct('event_id', event_id, 'label', {label}, 'period', CASE WHEN event_id % 6 > 0 THEN CAST(event_id % 4 AS STRING) ELSE 'soon' END{more}))"
    number, word, extra = "event_id % 9", "'L' || event_id % 8", ", 'extra', event_id % 7"
    text_of = f"CASE WHEN user_id % 10 = 0 THEN {event(number, extra)} WHEN user_id % 5 = 0 THEN {event(word, extra)} WHEN user_id % 2 = 0 THEN {event(number)} ELSE {event(word)} END"
    # Whole and broken numbers in one column.
    clock = "concat(', \"clock\": ', event_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE '.5' END, '}')"
    rows = table(spark, sf_dir, "events").selectExpr("user_id", "ts", f"concat(regexp_replace({text_of}, '[}}]$', ''), {clock}) AS e")
    listed = rows.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ts", "e"))), lambda x: x["e"]), ",").alias("e"))
    whole = F.concat(F.lit('{"pbp": ['), "e", F.when(F.col("user_id") % 10 == 3, F.lit("")).otherwise(F.lit("]}")))
    payloads = games_source.Payloads(listed.select(F.col("user_id").cast("string").alias("_cid"), whole.alias("payload")))
    return datasets.family(payloads.games("pbp"), "pbp", SEASON).select("contest_id", "season", "event_id", "label", "extra", "period", "clock")


@query(f"""WITH lineups AS ({ORACLES["season_lineups"]}), stints AS ({ORACLES["season_matchup_stints"]})
SELECT l.contest_id, l.lineup_key, count(*) AS n_pairs, count(DISTINCT s.game_stint_num) AS n_stints, CAST(sum(s.n_events) AS BIGINT) AS n_events FROM lineups l JOIN stints s ON s.contest_id = l.contest_id AND s.home_lineup_key = l.lineup_key GROUP BY ALL""")
def lineups_of_stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineups met by stints of the same five in the same contest, by the key that both datasets carry."""
    # Every lineup of a key meets every stint of it, so both are counted by key first and no pair is made.
    lineups = season_lineups(spark, sf_dir).groupBy("contest_id", "lineup_key").agg(F.count(F.lit(1)).alias("_lineups"))
    stints = season_matchup_stints(spark, sf_dir).groupBy("contest_id", F.col("home_lineup_key").alias("lineup_key"))
    stints = stints.agg(F.count("game_stint_num").alias("n_stints"), F.sum("n_events").alias("_events"))
    met = lineups.join(stints, ["contest_id", "lineup_key"])
    return met.select("contest_id", "lineup_key", (F.col("_lineups") * F.col("n_stints")).alias("n_pairs"), "n_stints", (F.col("_lineups") * F.col("_events")).alias("n_events"))


@query("""SELECT year(o_orderdate) AS season, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey DESC) <= 3""")
def first_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first files of each season, as a limited scan of page bundles takes them; an order is a file, the last ones first."""
    files = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("season"), "o_orderkey")
    return relational.first_per_group(files, ["season"], [F.col("o_orderkey").desc()], 3)


@query("""SELECT DISTINCT o_orderpriority AS dataset, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS season FROM orders
  EXCEPT SELECT o_orderpriority, year(o_orderdate) * 100 + month(o_orderdate) FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 40 = 0""")
def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of a sweep that are not live; a unit is a priority and a month of orders."""
    season = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long")
    units = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("dataset"), season.alias("season"), "o_orderstatus", "o_custkey")
    return sweep.missing_units(units, units.where("o_orderstatus = 'F' and o_custkey % 40 = 0"))
