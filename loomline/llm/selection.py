"""Exact k-th keys by radix selection: distributed histograms over a key's digits, most significant first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import stored

#: Bits of a digit where every group has a histogram of its own, and where there is a single one.
GROUP_BITS, SINGLE_BITS = 10, 16
#: Rows that tie at a group's threshold are ranked at once if no group has more; else their bytes are digits first.
TIES = 10_000
SIGN = -(1 << 63)


def group_thresholds(rows: DataFrame, by: list[str], value: str, bits: int, k: int) -> DataFrame:
    """(by, threshold, need) of each group: its k-th largest value, and how many rows of that value are among the k.

    Values are longs of 0 or more and below 2**bits. A group of fewer than k rows has its
    least value as threshold, and a need that covers all its ties. Each round keeps, of a
    group's rows, those whose leading bits equal its k-th value's; a histogram of their
    next bits, of 2**GROUP_BITS bins at most, gives the next digit. Rows are read once a round.
    """
    state = None
    for shift in range((bits - 1) // GROUP_BITS * GROUP_BITS, -1, -GROUP_BITS):
        live = rows.select(*by, value)
        if state is not None:
            live = live.join(state, by).where(F.shiftright(value, shift + GROUP_BITS) == F.col("prefix"))
        digit = F.shiftright(value, shift)
        bins = live.groupBy(*by, digit.alias("digit")).agg(F.count(F.lit(1)).alias("n"))
        listed = bins.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("digit", "n")), asc=False).alias("bins"))
        if state is None:
            listed = listed.withColumn("need", F.lit(k).cast("long"))
        else:
            listed = listed.join(state.drop("prefix"), by)
        # The first bin, from above, at which the running count reaches what is needed, or the last.
        start = F.struct(F.lit(None).cast("long").alias("prefix"), F.col("need").alias("need"), F.lit(0).cast("long").alias("n"))
        walk = lambda s, x: F.when(s["prefix"].isNull() | (s["n"] < s["need"]), F.struct(x["digit"].alias("prefix"), (s["need"] - s["n"]).alias("need"), x["n"].alias("n"))).otherwise(s)
        state = stored(listed.select(*by, F.aggregate("bins", start, walk).alias("s")).select(*by, "s.prefix", "s.need"), "digits")
    return state.withColumnRenamed("prefix", "threshold")


def refine_by_bytes(ties: DataFrame, by: list[str], item: str) -> DataFrame:
    """Of rows that tie, with a ``need`` per group, those that hold the ``need`` least items by UTF-8 bytes, and maybe up to TIES - 1 more a group.

    Items differ within a group. A group with over TIES rows goes two bytes on a round; the
    bytes before are settled.
    """
    place, settled = 1, None
    live = ties.withColumn("_bytes", F.encode(item, "UTF-8"))
    while True:
        sizes = live.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.first("need").alias("_need"))
        if sizes.where(f"_n > _need and _n > {TIES}").isEmpty():
            left = live.drop("_bytes")
            return left if settled is None else settled.unionByName(left)
        digit = F.substring("_bytes", place, 2)
        bins = live.groupBy(*by, digit.alias("_digit")).agg(F.count(F.lit(1)).alias("n"), F.first("need").alias("need"))
        listed = bins.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col("_digit").alias("digit"), "n"))).alias("bins"), F.first("need").alias("need"))
        start = F.struct(F.lit(None).cast("binary").alias("digit"), F.col("need").alias("need"), F.lit(0).cast("long").alias("n"))
        walk = lambda s, x: F.when(s["digit"].isNull() | (s["n"] < s["need"]), F.struct(x["digit"].alias("digit"), (s["need"] - s["n"]).alias("need"), x["n"].alias("n"))).otherwise(s)
        state = listed.select(*by, F.aggregate("bins", start, walk).alias("s")).select(*by, F.col("s.digit").alias("_at"), F.col("s.need").alias("_left"))
        met = stored(live.join(state, by).withColumn("_digit", digit), "ties")
        below = met.where("_digit < _at").select(*ties.columns)
        settled = below if settled is None else settled.unionByName(below)
        live = met.where("_digit = _at").withColumn("need", F.col("_left")).select(*ties.columns, "_bytes")
        place += 2


def largest(rows: DataFrame, by: list[str], value: str, item: str, bits: int, k: int) -> DataFrame:
    """The rows of each group's k largest values, ties to the item of lesser UTF-8 bytes, and maybe a bounded number of further ties.

    Items differ within a group. No group is sorted or gathered: what is returned is bounded by k and TIES a group.
    """
    thresholds = group_thresholds(rows, by, value, bits, k)
    met = rows.join(thresholds, by)
    above = met.where(F.col(value) > F.col("threshold")).select(*rows.columns)
    ties = met.where(F.col(value) == F.col("threshold")).select(*rows.columns, "need")
    return above.unionByName(refine_by_bytes(ties, by, item).select(*rows.columns))


def unsigned(key: Column, shift: int, bits: int) -> Column:
    """A digit of a long in the order of its bits: ``bits`` bits from ``shift`` on, of a key whose sign is flipped."""
    return F.shiftrightunsigned(key.bitwiseXOR(F.lit(SIGN)), shift).bitwiseAND(F.lit((1 << bits) - 1))


def kth_key(rows: DataFrame, keys: list[str], k: int) -> tuple[list[int], int] | None:
    """(the k-th least composite key of long columns, how many rows of that very key are among the k); None if there are fewer than k rows or k is 0.

    Every round filters by the digits found, and one histogram of up to 2**SINGLE_BITS
    counts comes to the driver. Bits that all rows left share are skipped.
    """
    if k < 1:
        return None
    found: list[int] = []
    live = rows.select(*keys)
    for key in keys:
        low, high, n = live.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
        if n < k:
            return None
        low, high = low - SIGN, high - SIGN
        shift = max(0, (low ^ high).bit_length())
        prefix = low >> shift
        while shift:
            step = min(SINGLE_BITS, shift)
            shift -= step
            counts = live.groupBy(unsigned(F.col(key), shift, step).alias("digit")).agg(F.count(F.lit(1)).alias("n")).collect()
            for digit, n in sorted(map(tuple, counts)):
                if n >= k:
                    break
                k -= n
            prefix = prefix << step | digit
            live = live.where(unsigned(F.col(key), shift, step) == digit)
        found.append(prefix + SIGN)
    return found, k
