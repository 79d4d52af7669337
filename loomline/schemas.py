"""Explicit schemas of what is read and of tables whose columns are fixed."""

from __future__ import annotations

from pyspark.sql import types as T

ON_COURT = [f"{side}_{i}" for side in ("home", "away") for i in range(1, 6)]


def struct(ddl: str) -> T.StructType:
    """The parsed schema; parsing needs a session, so the tables below stay text."""
    return T.StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    return struct(ddl).names


TOTAL = "struct<total: bigint>"
SHOT_STATS = f"struct<attempts: {TOTAL}, made: {TOTAL}, ast: {TOTAL}>"
SIDE_STATS = (
    "struct<num_events: bigint, num_possessions: bigint, pts: bigint, plus_minus: bigint, "
    + ", ".join(f"{k}: {SHOT_STATS}" for k in ("fg", "fg_rim", "fg_mid", "fg_2p", "fg_3p", "ft"))
    + ", "
    + ", ".join(f"{k}: {TOTAL}" for k in ("orb", "drb", "to", "stl", "blk", "assist", "foul"))
    + ">"
)
PLAYER = "struct<code: string, id: struct<name: string>>"
SCORE = "struct<scored: bigint, allowed: bigint>"
TEAM_YEAR = "struct<team: struct<name: string>, year: struct<value: bigint>>"

#: A stint of the nested lineups family.
LINEUP = (
    "struct<date: string, location_type: string, start_min: double, end_min: double, duration_mins: double, "
    f"score_info: struct<start: {SCORE}, end: {SCORE}, start_diff: bigint, end_diff: bigint>, "
    f"team: {TEAM_YEAR}, opponent: {TEAM_YEAR}, lineup_id: struct<value: string>, "
    f"players: array<{PLAYER}>, players_in: array<{PLAYER}>, players_out: array<{PLAYER}>, player_count_error: bigint, "
    f"team_stats: {SIDE_STATS}, opponent_stats: {SIDE_STATS}>"
)

#: The columns of an event that the engine itself reads; all others are inferred.
EVENT = {
    "period": "bigint", "game_seconds": "bigint", "home_score": "bigint", "away_score": "bigint",
    "home": "string", "away": "string", "game_date": "string", "poss_num": "bigint", "event_description": "string",
    **dict.fromkeys(ON_COURT, "string"),
}

ROSTER_PLAYER_FIELDS = ["gp", "gs", "jersey", "name", "class", "position", "height", "hometown", "high_school", "player", "clean_name"]
ROSTER_FILE = (
    "team_id string, team string, season bigint, league string, captured_at string, players array<struct<"
    + ", ".join(f"`{f}`: string" for f in ROSTER_PLAYER_FIELDS)
    + ", ht_inches: bigint, player_id: string>>, _corrupt_record string"
)
TEAM_ROSTERS = (
    "season bigint, team_id string, team string, player_id string, player string, clean_name string, name string, jersey string, "
    "`class` string, position string, height string, ht_inches bigint, hometown string, high_school string, gp string, gs string"
)
SCHEDULE = ("contest_id string, game_date string, home string, away string, home_score bigint, away_score bigint, season bigint")
ROSTERS = ("season bigint, team string, player string, games bigint")
MANIFEST = ("dataset string, season bigint, row_count bigint, generated_at_utc string")
NAME_CHANGES = ("season string, team string, name_game_time string, name_current string, n_games bigint")
EMPTY_FAMILY = ("contest_id string, season bigint")
