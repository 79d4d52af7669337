"""Small relational operators with defined behaviour on nulls, order and types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reorder(df: DataFrame, front: list[str], rest_sorted: bool = False) -> DataFrame:
    """The front columns that exist, then the others in their order or alphabetically."""
    lead = [c for c in front if c in df.columns]
    rest = [c for c in df.columns if c not in lead]
    return df.select(*lead, *(sorted(rest) if rest_sorted else rest))


def ordinal_rank(df: DataFrame, partition: list[str], by: str, ties: list[str], out: str) -> DataFrame:
    """Ranks 1, 2, ... in each partition by a column, ties by others; null where the column is null."""
    over = Window.partitionBy(*partition).orderBy(F.col(by).asc_nulls_last(), *ties)
    return df.withColumn(out, F.when(F.col(by).isNotNull(), F.row_number().over(over).cast("long")))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order."""
    over = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_first", F.row_number().over(over)).where("_first = 1").drop("_first")


def first_per_group(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """The first n rows of each key in an explicit order; Spark limits each task's rows of a key before they are shuffled."""
    over = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(over)).where(F.col("_place") <= n).drop("_place")


def relaxed_union(frames: list[DataFrame]) -> DataFrame:
    """Union by name: absent columns are null, and where types differ and are not both numbers, all become strings."""
    kinds: dict[str, set[str]] = {}
    for df in frames:
        for name, kind in df.dtypes:
            kinds.setdefault(name, set()).add(kind)
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    mixed = [n for n, k in kinds.items() if len(k - {"void"}) > 1 and not k <= numbers | {"void"}]
    cast = [df.withColumns({n: F.col(n).cast("string") for n in mixed if n in df.columns}) for df in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def upsert(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The current rows whose key is not renewed, and the new ones; null keys match each other."""
    same = reduce(lambda a, b: a & b, [current[k].eqNullSafe(new[k]) for k in keys])
    return current.join(new, same, "left_anti").unionByName(new, allowMissingColumns=True)


def any_flag(df: DataFrame, flags: list[str]) -> DataFrame:
    """Rows with a true flag; none if there are no flags."""
    present = [F.coalesce(F.col(f), F.lit(False)) for f in flags if f in df.columns]
    return df.where(reduce(lambda a, b: a | b, present)) if present else df.limit(0)


def ensure_flags(df: DataFrame, flags: list[str]) -> DataFrame:
    """Missing flag columns added as false, and all flags boolean."""
    return df.withColumns({f: F.col(f).cast("boolean") if f in df.columns else F.lit(False) for f in flags})


def presence_flags(index: DataFrame, key: str, members: dict[str, DataFrame]) -> DataFrame:
    """A boolean column per member table: whether it has the row's key.

    Members become one table of distinct (key, member) pairs, so a single join and one
    shuffle of the index serve all flags.
    """
    if not members:
        return index
    pairs = reduce(lambda a, b: a.unionByName(b), [df.select(F.col(key).alias("_key")).distinct().withColumn("_member", F.lit(name)) for name, df in members.items()])
    flags = pairs.groupBy("_key").agg(*[F.bool_or(F.col("_member") == name).alias(name) for name in members])
    joined = index.drop(*members).join(flags, F.col(key) == F.col("_key"), "left").drop("_key")
    return joined.withColumns({name: F.coalesce(F.col(name), F.lit(False)) for name in members})


def differences(built: DataFrame, live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows only built, rows only live)."""
    return built.subtract(live), live.subtract(built)


def require_column(df: DataFrame, name: str, kind: str, where: str) -> None:
    """Raise ValueError if the column is absent, TypeError if it is of another type; never coerce."""
    kinds = dict(df.dtypes)
    if name not in kinds:
        raise ValueError(f"{where}: no column {name}")
    if kinds[name] != kind:
        raise TypeError(f"{where}: {name} is {kinds[name]}, not {kind}")


def share(flag: Column) -> Column:
    """Part of rows whose flag is true."""
    return F.avg(flag.cast("int"))
