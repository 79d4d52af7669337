"""The coverage index: which games of the raw index are present in which dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import lenient_date
from loomline.operators.bitmaps import bitmap_flags, bitmaps_of, number_keys
from loomline.operators.relational import any_flag, ensure_flags, keep_first, reorder, require_column, share
from loomline.registry import flag_columns

DETAIL = ["game_date", "home", "away", "home_score", "away_score"]


def denominator(index: DataFrame | None) -> DataFrame:
    """Distinct (season, contest_id) of the raw index, season as a long."""
    if index is None:
        raise FileNotFoundError("the raw tree has no schedule index")
    require_column(index, "contest_id", "string", "schedule index")
    return index.select(F.col("season").cast("long").alias("season"), "contest_id").distinct()


def stamp(index: DataFrame, committed: dict[str, DataFrame]) -> DataFrame:
    """A flag per dataset: whether any committed season of it holds the contest; each dataset's ids are read as a bitmap over the index's contests."""
    for name, df in committed.items():
        require_column(df, "contest_id", "string", name)
    numbers = number_keys(index, "contest_id")
    return stamp_from(index, numbers, {name: bitmaps_of(df, numbers, "contest_id") for name, df in committed.items()})


def stamp_from(index: DataFrame, numbers: DataFrame, bitmaps: dict[str, DataFrame]) -> DataFrame:
    """The flags from bitmaps that are there already."""
    return ensure_flags(bitmap_flags(index, numbers, "contest_id", {f"in_{name}": df for name, df in bitmaps.items()}), flag_columns())


def add_detail(index: DataFrame, schedule: DataFrame | None) -> DataFrame:
    """Teams, date and scores of built games; others keep null. The first schedule row of a contest counts."""
    if schedule is None:
        return index
    require_column(schedule, "contest_id", "string", "schedule")
    require_column(schedule, "season", "bigint", "schedule")
    columns = [c for c in DETAIL if c in schedule.columns]
    first = keep_first(schedule.select("season", "contest_id", *columns), ["season", "contest_id"], columns or ["contest_id"])
    return index.join(first, ["season", "contest_id"], "left")


def build_index(index: DataFrame | None, committed: dict[str, DataFrame], presence: tuple[DataFrame, dict[str, DataFrame]] | None = None) -> DataFrame:
    """The full index with flags and detail, lead columns first and the rest in alphabetical order.

    ``presence`` are numbers and bitmaps, if they are kept; then only the schedule of the committed tables is read.
    """
    contests = denominator(index)
    full = add_detail(stamp(contests, committed) if presence is None else stamp_from(contests, *presence), committed.get("schedule"))
    return reorder(full, ["season", "contest_id"], rest_sorted=True).orderBy("season", "contest_id")


def present_games(full: DataFrame) -> DataFrame:
    """Games that any dataset holds."""
    return any_flag(full, flag_columns())


def coverage(full: DataFrame) -> DataFrame:
    """Per season: games, first and last date if dates are known, and the part of games in each dataset."""
    if "season" not in full.columns:
        raise ValueError("coverage needs a season column")
    dates = [F.min(lenient_date("game_date")).alias("first_date"), F.max(lenient_date("game_date")).alias("last_date")] if "game_date" in full.columns else []
    flags = [share(F.col(f)).alias(f"pct_{f}") for f in flag_columns() if f in full.columns]
    return full.groupBy("season").agg(F.count(F.lit(1)).alias("n_games"), *dates, *flags).orderBy("season")


def flag_totals(full: DataFrame) -> DataFrame:
    """How many games each flag holds."""
    return full.agg(*[F.sum(F.col(f).cast("int")).alias(f) for f in flag_columns() if f in full.columns])
