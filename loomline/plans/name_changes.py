"""Players whose name at game time differs from their present one, from page bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.pages import renamed_players


def changes(bundles: DataFrame) -> DataFrame:
    """(season, team, name_game_time, name_current, n_games): files in which the change occurs.

    Each page is walked once, where it is read: its shots and options meet by player id
    there, and only its changes are shuffled.
    """
    found = renamed_players(bundles.where("not corrupt and box_score <> ''"))
    return found.groupBy("season", "team", "name_game_time", "name_current").agg(F.count(F.lit(1)).alias("n_games")).orderBy("season", "team", "name_game_time", "name_current")


def unreadable(bundles: DataFrame) -> DataFrame:
    """Files that could not be parsed; a build with any must fail."""
    return bundles.where("corrupt").select("season", "file")
