"""Builders of the eleven datasets: DataFrame to DataFrame, lazy, without collecting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline import schemas
from loomline.functions import nested, text
from loomline.operators.relational import ordinal_rank, reorder
from loomline.operators.segments import gaps_and_islands
from loomline.schemas import ON_COURT

STINT_FRONT = [
    "season", "contest_id", "game_date", "game_stint_num", "matchup_key", "home", "away", "home_lineup_key", "away_lineup_key",
    "home_lineup", "away_lineup", "period", "start_seconds", "end_seconds", "duration_seconds",
]
#: What a stint is, for segments in batch and on a stream.
STINT_RUNS = {
    "change": ["home_lineup", "away_lineup", "period"],
    "segment": "game_stint_num",
    "firsts": {c: c for c in ("game_date", "home", "away", "period", "home_lineup", "away_lineup", "_hl", "_al")} | {"start_seconds": "game_seconds"},
    "lasts": {"end_seconds": "game_seconds", "end_home_score": "home_score", "end_away_score": "away_score"},
    "distincts": {"n_possessions": "poss_num"},
    "count": "n_events",
    "starts": {"start_home_score": "end_home_score", "start_away_score": "end_away_score"},
}
NEEDED_IN_A_GAME = ["period", "game_seconds", "home_score", "away_score", "home", "away"]
#: The columns of an event that stints are made of.
STINT_COLUMNS = ["game_date", "poss_num", *NEEDED_IN_A_GAME, *ON_COURT]


def tagged(df: DataFrame, season: int, contest: str | None = None) -> DataFrame:
    """Add the season, and the contest id from a column, over any of the same name."""
    columns = {"season": F.lit(season).cast("long")} | ({"contest_id": F.col(contest).cast("string")} if contest else {})
    return df.withColumns(columns)


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """The rows in a global order of the columns.

    The bounds of its ranges are taken from a sample of the rows, which runs what made them once more;
    behind an exchange that is no more than reading them again.
    """
    return df.repartition(*columns).orderBy(*columns)


def family(games: DataFrame, name: str, season: int) -> DataFrame:
    """A family of all games, in order of contest and array position, with contest id and season.

    Rows take the id of the payload's file. A family that no game has gives only those two columns.
    """
    rows = nested.explode_family(games, name, ["_cid"]).drop("_none")
    if name == "pbp":
        rows = text.event_features(rows)
    if name == "lineups":
        rows = flat_lineups(rows)
    out = in_order(tagged(rows, season, "_cid"), "contest_id", "_pos")
    return out.drop("_cid", "_pos")


def flat_lineups(rows: DataFrame) -> DataFrame:
    """Nested stints as 77 flat columns less the tags: key, stint, both sides' statistics, and the rank in the team."""
    named = rows.withColumn("_names", F.sort_array(nested.player_names(F.col("players"))))
    keyed = text.add_lineup_keys(named.withColumn("_team_name", F.col("team.team.name")), {"lineup_key": ("_team_name", "_names")})
    flat = keyed.select("_cid", "_pos", "lineup_key", *nested.lineup_columns(F.col("_names"))).withColumnsRenamed(nested.FLAT_NAMES)
    return ordinal_rank(flat, ["_cid", "team"], "start_min", ["_pos"], "stint_num")


def schedule(games: DataFrame, season: int) -> DataFrame:
    """One row per game with events: highest scores, null counting as 0, and the first row's teams and date."""
    events = nested.explode_family(games, "pbp", ["contest_id"])
    best = lambda c: F.max(F.coalesce(c, F.lit(0))).alias(c)
    first = lambda c: F.min_by(c, "_pos").alias(c)
    out = events.groupBy("contest_id").agg(first("game_date"), first("home"), first("away"), best("home_score"), best("away_score"))
    return tagged(out, season).select(*schemas.names(schemas.SCHEDULE)).orderBy("contest_id")


def rosters(games: DataFrame, season: int) -> DataFrame:
    """Players by team with the number of games they are in; null names are a group."""
    box = nested.explode_family(games, "player_box", ["contest_id"])
    out = box.groupBy("team", "player").agg(F.count_distinct("contest_id").alias("games"))
    return in_order(tagged(out, season).select(*schemas.names(schemas.ROSTERS)), "team", "player")


def team_rosters(files: DataFrame, season: int) -> DataFrame:
    """Players of roster files; team ids are text, a missing one the word None."""
    rows = files.select(F.coalesce("team_id", F.lit("None")).alias("team_id"), "team", F.explode("players").alias("_p"))
    flat = rows.select("team_id", "team", "_p.*")
    return tagged(flat, season).select(*schemas.names(schemas.TEAM_ROSTERS)).orderBy("team", "name")


def team_ids(crosswalk: DataFrame, season: int) -> DataFrame:
    """A season's rows of the external crosswalk, id as text and season as its ending year; maybe none."""
    rows = crosswalk.where(F.col("season") == text.season_label(season))
    return tagged(rows.withColumn("id", F.col("id").cast("string")), season)


def matchup_stints(games: DataFrame, season: int, hot_rows: int | None = None) -> DataFrame:
    """Maximal runs of events of a game with the same ten players and period.

    Rows without all ten players are dropped before runs are formed, so points scored
    meanwhile go to the next run. A game in which a needed column has no value at all is
    skipped. Scores start from 0 and a run's points are the change of the running score.
    With ``hot_rows``, contests of more events are segmented in slices.
    """
    names = games.schema["pbp"].dataType.elementType.names
    if not {*NEEDED_IN_A_GAME, *ON_COURT} <= set(names):
        games = games.limit(0)
    else:
        # Told by the game's own list, before it is taken apart.
        some = lambda c: F.exists("pbp", lambda e: e[c].isNotNull())
        games = games.where(reduce(lambda a, b: a & b, map(some, NEEDED_IN_A_GAME)))
    events = nested.explode_family(games, "pbp", ["contest_id"])
    for c in STINT_COLUMNS:
        if c not in names:
            events = events.withColumn(c, F.lit(None).cast(schemas.EVENT[c]))
    runs = gaps_and_islands(on_court(events), partition=["contest_id"], order=["_pos"], **STINT_RUNS, hot_rows=hot_rows)
    return in_order(keyed_stints(runs, season), "contest_id", "game_stint_num")


def on_court(events: DataFrame) -> DataFrame:
    """Events with all ten players, and both lineups as sorted arrays and as text."""
    five = lambda side: F.sort_array(F.array(*[f"{side}_{i}" for i in range(1, 6)]))
    usable = events.dropna(how="any", subset=ON_COURT).withColumns({"_hl": five("home"), "_al": five("away")})
    return usable.withColumns({"home_lineup": F.array_join("_hl", "|"), "away_lineup": F.array_join("_al", "|")})


def keyed_stints(runs: DataFrame, season: int) -> DataFrame:
    """Runs as stints: points, duration, keys of both lineups and of the matchup, players as columns."""
    runs = runs.withColumns({
        "home_pts": F.col("end_home_score") - F.col("start_home_score"),
        "away_pts": F.col("end_away_score") - F.col("start_away_score"),
        "duration_seconds": F.col("end_seconds") - F.col("start_seconds"),
    })
    keyed = text.add_lineup_keys(runs, {"home_lineup_key": ("home", "_hl"), "away_lineup_key": ("away", "_al")})
    keyed = keyed.withColumn("matchup_key", F.concat("home_lineup_key", F.lit("_"), "away_lineup_key"))
    wide = keyed.select("*", *nested.padded(F.col("_hl"), "home_"), *nested.padded(F.col("_al"), "away_")).drop("_hl", "_al")
    return reorder(tagged(wide, season), STINT_FRONT)
