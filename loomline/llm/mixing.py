"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Document rates w minimise the relative entropy
to rate 1 under that constraint, with rates of at most ``cap``: the solution is the tilted
rate ``w = min(cap, exp(l * size / mean size))`` with one multiplier l per source, found by
Newton iterations on the dual. Rates depend on source and size alone, so the iterations
run over the histogram of (source, size), whose rows are far fewer than the documents.
Rates are then rounded to whole copies so that each source's words stay near its target.

Everything here is DataFrame operations; state is one row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import cut, word_count

#: Within a group of documents alike in source and size, ranks are taken in so many salted bins, or more, of about so many rows at most.
BINS, BIN_ROWS = 64, 16_384
#: Steps that make up for what is missing of a target.
FILLS = 8
ITERATIONS, TOLERANCE = 40, 1e-7


def cycle_weights(rank: Column, weights: tuple[int, ...]) -> Column:
    """The weights in turn, by a 1-based rank."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))


def source_targets(hist: DataFrame, weights: tuple[int, ...], cap: float) -> DataFrame:
    """(r, source, source_size, mean, target) of each source.

    Targets share all words by weight; where a target would exceed ``cap`` times the
    source's own words it stops there and the excess is shared by weight among the others,
    until none is above. That is one water level: sources are capped in ascending order of
    capacity per weight, and the level is what is left over the weights left.
    """
    by_source = hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("_rows"))
    # One row per source meets here, as the order of the sources is global.
    ranked = by_source.withColumn("r", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = ranked.withColumn("_weight", cycle_weights(F.col("r"), weights)).withColumn("_most", F.lit(cap) * F.col("source_size"))
    order = Window.orderBy(F.col("_most") / F.col("_weight"), "r")
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    leveled = w.withColumn("_level", level).withColumn("_capped", F.col("_level") * F.col("_weight") >= F.col("_most"))
    final = F.min(F.when(~F.col("_capped"), F.struct(F.col("_most") / F.col("_weight"), F.col("r"), F.col("_level")))).over(everything)["_level"]
    return leveled.select(
        "r", "source", "source_size", F.when(F.col("source_size") > 0, F.col("source_size") / F.col("_rows")).otherwise(1.0).alias("mean"),
        F.least(F.col("_most"), F.coalesce(final * F.col("_weight"), F.col("_most"))).alias("target"),
    )


def rate(cap: float) -> Column:
    """The tilted rate of a histogram row beside its source's multiplier ``l``."""
    return F.exp(F.least(F.col("l") * F.col("size") / F.col("mean"), F.lit(math.log(cap))))


def solve(hist: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """Multipliers (r, l) by Newton steps on the logarithm of the words taken, inside a bracket that shrinks."""
    words = F.sum(F.col("n") * F.col("size") * F.col("w"))
    free = F.col("l") * F.col("size") / F.col("mean") < math.log(cap)
    slope = F.sum(F.when(free, F.col("n") * F.col("size") * F.col("size") / F.col("mean") * F.col("w")).otherwise(0.0))
    smallest = F.min(F.when(F.col("size") > 0, F.col("size") / F.col("mean")))
    full = hist.join(sources.select("r", "mean", "source_size", "target"), "r")
    grow = F.col("target") > F.col("source_size")
    state = full.groupBy("r").agg(F.first("target").alias("target"), F.first("source_size").alias("source_size"), F.coalesce(smallest, F.lit(1.0)).alias("_least"))
    state = cut(state.select("r", F.lit(0.0).alias("l"), F.when(grow, 0.0).otherwise(-math.inf).alias("lo"), F.when(grow, math.log(cap) / F.col("_least")).otherwise(0.0).alias("hi"), F.lit(1.0).alias("gap")))
    for _ in range(ITERATIONS):
        got = full.join(state.select("r", "l"), "r").withColumn("w", rate(cap))
        sums = got.groupBy("r").agg(words.alias("_words"), slope.alias("_slope"), F.first("target").alias("_target"))
        s = state.join(sums, "r").withColumns({
            "lo": F.when(F.col("_words") <= F.col("_target"), F.greatest("lo", "l")).otherwise(F.col("lo")),
            "hi": F.when(F.col("_words") >= F.col("_target"), F.least("hi", "l")).otherwise(F.col("hi")),
            "gap": F.coalesce(F.abs(F.col("_words") / F.nullif("_target", F.lit(0.0)) - 1), F.lit(0.0)),
        })
        step = F.col("l") + (F.log(F.col("_target")) - F.log(F.col("_words"))) * F.col("_words") / F.nullif("_slope", F.lit(0.0))
        inside = (step > F.col("lo")) & (step < F.col("hi"))
        middle = F.when(F.col("lo") == -math.inf, F.col("l") * 2 - 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        new = F.when(F.col("gap") < TOLERANCE, F.col("l")).when(inside, step).when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(middle)
        state = cut(s.select("r", new.alias("l"), "lo", "hi", "gap"))
        if (state.agg(F.max("gap").alias("g")).first()["g"] or 0.0) < TOLERANCE:
            break
    return state.select("r", "l")


def copies_per_group(hist: DataFrame, sources: DataFrame, multipliers: DataFrame, cap: int) -> DataFrame:
    """(r, size, n, copies): whole copies of all documents of a source and size together.

    Running sums of rates in descending size are rounded down, which never takes more
    than the target and leaves less than the largest size missing. That is made up, FILLS times, by
    the largest size that fits and has room, which halves what is missing, or comes far nearer
    where sizes are many, or uses a size up. All of it is windows over a source's distinct sizes, one row each.
    """
    w = hist.join(sources.select("r", "mean", "target"), "r").join(multipliers, "r").withColumn("w", rate(float(cap)))
    down = Window.partitionBy("r").orderBy(F.col("size").desc())
    whole = Window.partitionBy("r")
    floors = w.withColumn("_upto", F.floor(F.sum(F.col("n") * F.col("w")).over(down.rowsBetween(Window.unboundedPreceding, 0)) + 1e-6))
    filled = floors.withColumn("copies", F.least(F.col("_upto") - F.lag("_upto", 1, 0).over(down), F.col("n") * cap))

    for _ in range(FILLS):
        left = (F.max("target").over(whole) - F.sum(F.col("copies") * F.col("size")).over(whole)).cast("long")
        filled = filled.withColumns({"_left": left, "_room": F.when(F.col("size") > 0, F.col("n") * cap - F.col("copies")).otherwise(0)})
        filled = filled.withColumn("_largest", F.max(F.when((F.col("_room") > 0) & (F.col("size") <= F.col("_left")), F.col("size"))).over(whole))
        more = F.least(F.floor(F.col("_left") / F.nullif("size", F.lit(0))), F.col("_room"))
        filled = filled.withColumn("copies", F.col("copies") + F.when(F.col("size") == F.col("_largest"), more).otherwise(0))
    return filled.select("r", "size", "n", F.col("copies").cast("long").alias("copies"))


def rank_bins(sized: DataFrame, hist: DataFrame) -> DataFrame:
    """The rows with ``_hash`` and ``_bin``: a group alike in source and size is ranked in BINS bins, one of over BIN_ROWS rows a bin in as many as it needs."""
    hashed = sized.withColumn("_hash", F.xxhash64("doc_id"))
    large = hist.where(F.col("n") > BINS * BIN_ROWS).select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.ceil(F.col("n") / BIN_ROWS).alias("_bins"))
    if large.isEmpty():
        return hashed.withColumn("_bin", F.pmod("_hash", F.lit(BINS)))
    # There is at most one such group for BINS * BIN_ROWS documents.
    met = hashed.join(F.broadcast(large), hashed["source"].eqNullSafe(large["_s"]) & (hashed["size"] == large["_z"]), "left")
    return met.withColumn("_bin", F.pmod("_hash", F.coalesce("_bins", F.lit(BINS)))).drop("_s", "_z", "_bins")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """The documents with ``size`` (words), ``source_size``, ``target`` and ``copies`` (0 to ``cap``).

    Sources in code point order, null last, weigh ``weights`` in turn. A null or empty
    text has size 0 and keeps one copy. Within a group alike in source and size, copies
    differ by one at most and a hash of doc_id decides who gets the further one; rows that
    are equal in doc_id are told apart arbitrarily but number the same on each run. An
    empty table gives an empty result. Input columns named as the added ones are replaced.
    """
    sized = docs.withColumn("size", word_count("text"))
    hist = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    sources = cut(source_targets(hist, weights, float(cap)))
    same_source = hist["source"].eqNullSafe(sources["source"])
    ranked_hist = cut(hist.join(sources.select("source", "r"), same_source).select("r", "size", "n"))
    per_group = copies_per_group(ranked_hist, sources, solve(ranked_hist, sources, float(cap)), cap)
    plan = cut(per_group.join(sources, "r").select(F.col("source").alias("_source"), F.col("size").alias("_size"), "n", F.col("copies").alias("_copies"), "source_size", "target"))
    placed = rank_bins(sized.drop("source_size", "target", "copies", "_bin", "_rank"), hist)
    in_bin = placed.withColumn("_rank", F.row_number().over(Window.partitionBy("source", "size", "_bin").orderBy("_hash", "doc_id")))
    bins = placed.groupBy("source", "size", "_bin").agg(F.count(F.lit(1)).alias("_rows"))
    upto = F.sum("_rows").over(Window.partitionBy("source", "size").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    quota = bins.withColumn("_before", F.coalesce(upto, F.lit(0)))
    quota = quota.join(plan, quota["source"].eqNullSafe(plan["_source"]) & (quota["size"] == plan["_size"])).select(
        F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("_bin").alias("_b"), "source_size", "target",
        F.floor(F.col("_copies") / F.col("n")).alias("_each"), (F.col("_copies") % F.col("n") - F.col("_before")).alias("_further"),
    )
    on = in_bin["source"].eqNullSafe(quota["_s"]) & (in_bin["size"] == quota["_z"]) & (in_bin["_bin"] == quota["_b"])
    joined = in_bin.join(quota, on)
    return joined.withColumn("copies", (F.col("_each") + (F.col("_rank") <= F.col("_further")).cast("long")).cast("int")).drop("_hash", "_bin", "_rank", "_s", "_z", "_b", "_each", "_further")


def repeat_copies(mixed: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say."""
    return mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("_copy")
