"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import cut

#: The ring has so many cells; virtual nodes sit on cell borders. The counts per cell are all that the driver sees.
CELL_BITS = 16
#: Rows alike in the key are counted and ranked in so many lots; any other row is a lot of its own.
SALTS = 4096


def node_cells(shards: int, virtual: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node around the ring; a node depends on its shard alone.

    Where two nodes fall on one cell, the one of the lower shard keeps it, so a further
    shard never moves the nodes of those before it.
    """
    taken: dict[int, int] = {}
    for shard in range(shards):
        for v in range(virtual):
            digest = hashlib.blake2b(f"{shard}:{v}".encode(), digest_size=8).digest()
            taken.setdefault(int.from_bytes(digest, "big") >> (64 - CELL_BITS), shard)
    return sorted(taken.items())


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Rows that each shard may hold: with slack 1 its exact share, else that many times the mean, rounded up."""
    if slack < 1:
        raise ValueError("the slack must be 1 or more")
    return [total // shards + (s < total % shards) for s in range(shards)] if slack == 1 else [math.ceil(total * slack / shards)] * shards


def bounded_pieces(counts: dict[int, int], shards: int, virtual: int, slack: float = 1.0) -> list[tuple[int, int, int, int]]:
    """(cell, rows of the cell up to which this holds, shard, first slot) so that no shard exceeds its capacity.

    Cells are walked clockwise. A cell belongs to the first node at or after it. That
    shard takes the cell's rows while it has room; the rows beyond continue clockwise to the
    next node whose shard has room. With slack 1 capacities sum to the number of rows, so all get full.
    """
    nodes, total = node_cells(shards, virtual), sum(counts.values())
    room = capacities(total, shards, slack)
    used, over, out = [0] * shards, [], []

    def take(cell: int, done: int, left: int, shard: int) -> int:
        n = min(left, room[shard])
        if n:
            out.append((cell, done + n, shard, used[shard] - done))
            room[shard] -= n
            used[shard] += n
        return n

    at = 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        first = at % len(nodes)
        got = take(cell, 0, counts[cell], nodes[first][1])
        if got < counts[cell]:
            over.append((cell, got, first))
    for cell, done, first in over:
        k = first
        while done < counts[cell]:
            k = (k + 1) % len(nodes)
            done += take(cell, done, counts[cell] - done, nodes[k][1])
    return sorted(out)


def assign_shards(docs: DataFrame, key: list[Column], shards: int = 40, virtual: int = 64, slack: float = 1.0) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard).

    With slack 1, row counts differ by one at most; a larger slack lets shards fill to that
    many times the mean, and a further shard then moves fewer rows. A row's place on the ring is a
    hash of ``key``; rows of one cell are ordered by that hash, so reruns agree. Rows
    alike in the key are interchangeable and are ranked in salted lots. Nulls are keys like any other.
    An empty table gives an empty result.
    """
    cell = F.shiftrightunsigned("_place", 64 - CELL_BITS).cast("int")
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS))
    named = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(key)])
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    placed = cut(docs.select(row.alias("_in"), named.alias("_key"), F.xxhash64(*key).alias("_place"), salt.alias("_salt")))
    groups = placed.groupBy("_place", "_salt").agg(F.count(F.lit(1)).alias("_n")).withColumn("_cell", cell)
    counts = {r["_cell"]: r["n"] for r in groups.groupBy("_cell").agg(F.sum("_n").alias("n")).collect()}  # as many as the ring has cells, at most
    pieces = docs.sparkSession.createDataFrame(bounded_pieces(counts, shards, virtual, slack), "_cell int, _until long, _shard int, _first long")
    lists = pieces.groupBy("_cell").agg(F.sort_array(F.collect_list(F.struct("_until", "_shard", "_first"))).alias("_pieces"))
    before = Window.partitionBy("_cell").orderBy("_place", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = groups.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_place", "_salt", "_cell", "_base")
    in_lot = placed.withColumn("_row", F.row_number().over(Window.partitionBy("_place", "_salt").orderBy("_key")) - 1)
    ranked = in_lot.join(bases, ["_place", "_salt"]).withColumn("_rank", F.col("_base") + F.col("_row"))
    # As many rows as the ring has cells, at most, whatever the data.
    joined = ranked.join(F.broadcast(lists), "_cell").withColumn("_piece", F.filter("_pieces", lambda p: F.col("_rank") < p["_until"])[0])
    kept = [F.col(f"_in.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return joined.select(*kept, F.col("_piece._shard").alias("shard"), (F.col("_piece._first") + F.col("_rank")).alias("slot"))
