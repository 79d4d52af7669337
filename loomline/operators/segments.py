"""Gaps-and-islands segmentation of ordered streams, also where one key holds most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slices that a hot partition is cut into at most, and cuts in all that are broadcast.
SLICES, BROADCAST_ROWS = 1024, 100_000
#: Types whose values can be cut at quantiles.
ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def differs(now: list[Column], before: list[Column]) -> Column:
    """Whether any value differs from the one before. A comparison with null counts as a change, unless another pair already settles it."""
    return F.coalesce(reduce(lambda a, b: a | b, [a != b for a, b in zip(now, before, strict=True)]), F.lit(True))


def segment_breaks(change: list[str], over) -> Column:
    """True where any of the columns differs from the row before, and on the first row of a partition."""
    return differs([F.col(c) for c in change], [F.lag(c).over(over) for c in change]) | (F.row_number().over(over) == 1)


def hot_slices(df: DataFrame, partition: list[str], by: str, hot_rows: int) -> tuple[DataFrame, bool] | None:
    """(partition, _cuts): values of ``by`` that cut each partition of over ``hot_rows`` rows into about equal slices, and whether that is small; None if there is none.

    Two aggregations with partial sums: one counts every partition, one sketches quantiles of
    the hot ones. Up to BROADCAST_ROWS cuts are held by the driver and broadcast.
    """
    keys = [f"_hot_{i}" for i in range(len(partition))]
    counts = df.groupBy(*[F.col(c).alias(k) for c, k in zip(partition, keys, strict=True)]).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    found, largest = counts.agg(F.count(F.lit(1)), F.max("_rows")).first()
    if not found:
        return None
    n = min(SLICES, -(-largest // hot_rows))
    small = found * n <= BROADCAST_ROWS
    rows = df.select(*partition, by).join(F.broadcast(counts) if small else counts, same(partition, keys))
    cuts = rows.groupBy(*keys).agg(F.percentile_approx(by, [i / n for i in range(1, n)], 10 * n).alias("_cuts"))
    return (df.sparkSession.createDataFrame(cuts.collect(), cuts.schema) if small else cuts), small


def same(left: list[str], right: list[str]) -> Column:
    """Null-safe equality of two lists of columns."""
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True)])


def numbered(df: DataFrame, partition: list[str], order: list[str], change: list[str], segment: str, lags: list[str]) -> DataFrame:
    """The rows with their segment's number, and ``_was_<column>`` of the row before in the partition; all behind one exchange."""
    over = Window.partitionBy(*partition).orderBy(*order)
    running = over.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = df.withColumns({"_break": segment_breaks(change, over).cast("int"), **{f"_was_{c}": F.lag(c).over(over) for c in lags}, "_first": F.row_number().over(over) == 1})
    return marked.withColumn(segment, F.sum("_break").over(running).cast("long"))


def numbered_in_slices(df: DataFrame, partition: list[str], order: list[str], change: list[str], segment: str, lags: list[str], cuts: DataFrame, small: bool) -> DataFrame:
    """As ``numbered``, with each hot partition numbered slice by slice.

    Slices are numbered from 1 each, in tasks of their own. Their first and last rows, one
    pair a slice, are then put in order: where a slice goes on with the last segment of the
    one before, its first segment is that one. The running sum of segments is added back.
    """
    keys = [f"_hot_{i}" for i in range(len(partition))]
    placed = df.join(F.broadcast(cuts) if small else cuts, same(partition, keys), "left").drop(*keys)
    below = F.size(F.filter("_cuts", lambda x: x < F.col(order[0])))
    sliced = placed.withColumn("_slice", F.when(F.col("_cuts").isNull() | F.col(order[0]).isNull(), 0).otherwise(below)).drop("_cuts")
    local = numbered(sliced, [*partition, "_slice"], order, change, segment, lags)
    ends = {c: F.col(c).alias(f"_{i}") for i, c in enumerate(dict.fromkeys([*change, *lags]))}
    at, row = F.struct(*order), F.struct(*ends.values())
    slices = local.groupBy(*partition, "_slice").agg(F.min_by(row, at).alias("_head"), F.max_by(row, at).alias("_tail"), F.max(segment).alias("_segments"))
    over = Window.partitionBy(*partition).orderBy("_slice")
    slices = slices.withColumn("_last", F.lag("_tail").over(over))
    value = lambda end, c: F.col(f"{end}._{list(ends).index(c)}")
    goes_on = F.col("_last").isNotNull() & ~differs([value("_head", c) for c in change], [value("_last", c) for c in change])
    slices = slices.withColumn("_joined", goes_on.cast("long"))
    before = F.sum(F.col("_segments") - F.col("_joined")).over(over.rowsBetween(Window.unboundedPreceding, -1))
    # Only slices after a first one change anything; there are no more of them than cuts.
    later = slices.select(*[F.col(c).alias(k) for c, k in zip(partition, keys, strict=True)], F.col("_slice").alias("_at"), "_last", (before - F.col("_joined")).alias("_offset")).where("_last is not null")
    met = local.join(F.broadcast(later) if small else later, same([*partition, "_slice"], [*keys, "_at"]), "left")
    # The first row of a slice follows the last one of the slice before.
    follows = F.col("_first") & F.col("_last").isNotNull()
    was = {f"_was_{c}": F.when(follows, value("_last", c)).otherwise(F.col(f"_was_{c}")) for c in lags}
    out = met.withColumns({segment: F.col(segment) + F.coalesce("_offset", F.lit(0)), "_first": F.col("_first") & F.col("_last").isNull(), **was})
    return out.drop("_slice", "_at", "_last", "_offset", *keys)


def gaps_and_islands(
    df: DataFrame,
    *,
    partition: list[str],
    order: list[str],
    change: list[str],
    segment: str = "segment",
    firsts: dict[str, str] | None = None,
    lasts: dict[str, str] | None = None,
    distincts: dict[str, str] | None = None,
    count: str | None = None,
    starts: dict[str, str] | None = None,
    deltas: dict[str, str] | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per run of rows whose ``change`` columns stay equal.

    ``firsts`` and ``lasts`` map output names to columns read at the run's first and last
    row, ``distincts`` to columns whose non-null values are counted, ``starts`` to outputs of
    ``lasts`` whose value in the run before is wanted (0 for the first run), and ``deltas`` to outputs
    of ``lasts`` whose difference from that value is. ``order`` is a total order of a partition's rows.

    As a rule everything runs behind a single exchange on ``partition``: grouping by that and the
    segment number is satisfied by the same distribution. With ``hot_rows``, partitions are
    counted first; those of more rows are cut into slices by quantiles of the first order column, which must
    then be a number or a time, and their segments are numbered slice by slice and stitched. Rows that
    tie in that column, or are null there, stay in one slice. The result is the same.
    """
    lasts, starts, deltas = lasts or {}, starts or {}, deltas or {}
    outside = {*starts.values(), *deltas.values()} - set(lasts)
    if outside:
        raise ValueError(f"starts and deltas must name outputs of lasts, not {', '.join(sorted(outside))}")
    lags = list(dict.fromkeys(lasts[c] for c in [*starts.values(), *deltas.values()]))
    cuts = None
    if hot_rows:
        if not isinstance(df.schema[order[0]].dataType, ORDERED):
            raise TypeError(f"{order[0]} is neither a number nor a time, so hot partitions cannot be cut by it")
        cuts = hot_slices(df, partition, order[0], hot_rows)
    rows = numbered(df, partition, order, change, segment, lags) if cuts is None else numbered_in_slices(df, partition, order, change, segment, lags, *cuts)
    rows = rows.withColumn("_at", F.struct(*order))
    aggregates = [F.min_by(c, "_at").alias(name) for name, c in (firsts or {}).items()]
    aggregates += [F.max_by(c, "_at").alias(name) for name, c in lasts.items()]
    if count:
        aggregates.append(F.count(F.lit(1)).alias(count))
    aggregates += [F.count_distinct(c).alias(name) for name, c in (distincts or {}).items()]
    # What the run before ended with stands beside the run's first row.
    aggregates += [F.min_by(F.when(F.col("_first"), F.lit(0)).otherwise(F.col(f"_was_{c}")), "_at").alias(f"_start_{c}") for c in lags]
    out = rows.groupBy(*partition, segment).agg(*aggregates)
    out = out.withColumns({name: F.col(f"_start_{lasts[c]}") for name, c in starts.items()})
    out = out.withColumns({name: F.col(c) - F.col(f"_start_{lasts[c]}") for name, c in deltas.items()})
    return out.drop(*[f"_start_{c}" for c in lags])
