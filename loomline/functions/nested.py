"""Nested families: explode, null-safe paths, and the flat lineup row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Flat statistics of a lineup's side, and where they stand in the nested record.
SHOT_KINDS = {"fg": ("fga", "fgm", None), "fg_rim": ("rima", "rimm", "rim_ast"), "fg_mid": ("mida", "midm", "mid_ast"), "fg_2p": ("fg2a", "fg2m", None), "fg_3p": ("tpa", "tpm", "tp_ast"), "ft": ("fta", "ftm", None)}
STATS = {"poss": "num_possessions", "pts": "pts", "plus_minus": "plus_minus"}
for _kind, (_tried, _made, _assisted) in SHOT_KINDS.items():
    STATS |= {_tried: f"{_kind}.attempts.total", _made: f"{_kind}.made.total"} | ({_assisted: f"{_kind}.ast.total"} if _assisted else {})
STATS |= {k: f"{k}.total" for k in ("orb", "drb", "to", "stl", "blk")} | {"ast": "assist.total", "foul": "foul.total"}


def player_names(players: Column) -> Column:
    """Names of an array of players, without missing and empty ones; empty for null."""
    names = F.filter(F.transform(players, lambda p: p["id"]["name"]), lambda n: n.isNotNull() & (n != ""))
    return F.coalesce(names, F.expr("cast(array() as array<string>)"))


def joined_or_null(names: Column) -> Column:
    return F.nullif(F.array_join(names, " | "), F.lit(""))


def padded(values: Column, prefix: str, n: int = 5) -> list[Column]:
    """The first n elements as columns; null where there are fewer."""
    return [F.get(values, i).alias(f"{prefix}{i + 1}") for i in range(n)]


def explode_family(games: DataFrame, family: str, keep: list[str]) -> DataFrame:
    """One row per element of the family, with its fields, the kept columns and its position.

    Games whose family is null or empty have no rows. ``games`` holds the family as an array of structs.
    """
    rows = games.select(*keep, F.posexplode(family).alias("_pos", "_row"))
    fields = [f for f in rows.schema["_row"].dataType.names if f not in {*keep, "_pos"}]
    return rows.select(*keep, "_pos", *[F.col("_row").getField(f).alias(f) for f in fields])


def lineup_columns(names: Column) -> list[Column]:
    """The flat columns of a nested stint but its key; ``names`` is the sorted array of its players."""
    stint = [
        F.col("date"), F.col("location_type"), F.col("team.team.name").alias("team_name"), F.col("team.year.value").alias("team_year"),
        F.col("opponent.team.name").alias("opponent_name"), F.col("lineup_id.value").alias("lineup_id_value"), F.col("start_min"), F.col("end_min"), F.col("duration_mins"),
        *padded(names, "player_"),
        joined_or_null(player_names(F.col("players_in"))).alias("players_in_names"), joined_or_null(player_names(F.col("players_out"))).alias("players_out_names"),
        *[F.col(f"score_info.{at}.{what}").alias(f"{at}_{what}") for at in ("start", "end") for what in ("scored", "allowed")],
        F.col("score_info.start_diff").alias("start_diff"), F.col("score_info.end_diff").alias("end_diff"), F.col("player_count_error"),
    ]
    sides = [F.col(f"{side}.{path}").alias(f"{prefix}{name}") for prefix, side in (("", "team_stats"), ("opp_", "opponent_stats")) for name, path in STATS.items()]
    return stint + sides


FLAT_NAMES = {"team_name": "team", "opponent_name": "opponent", "lineup_id_value": "lineup_id", "players_in_names": "players_in", "players_out_names": "players_out"}
