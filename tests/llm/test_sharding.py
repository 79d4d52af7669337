from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomline.llm import common, sharding
from tests.llm import docs as D


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 65535), st.integers(1, 50), max_size=60), st.integers(1, 9))
def test_loads_are_bounded_and_every_row_has_a_place(counts, shards):
    pieces = sharding.bounded_pieces(counts, shards, 8)
    loads, until = Counter(), {}
    slots = {s: [] for s in range(shards)}
    for cell, end, shard, first in pieces:
        begin = until.get(cell, 0)
        loads[shard] += end - begin
        slots[shard] += range(first + begin, first + end)
        until[cell] = end
    assert until == counts
    assert max(loads[s] for s in range(shards)) - min(loads[s] for s in range(shards)) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_rows_are_balanced_and_alike_on_each_run(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("clash").alias("size"))
    a = {r.doc_id: r.shard for r in sharding.assign_shards(docs, [F.col("doc_id")], shards=10).collect()}
    assert set(Counter(a.values()).values()) == {500}
    again = {r.doc_id: r.shard for r in sharding.assign_shards(docs.repartition(7), [F.col("doc_id")], shards=10).collect()}
    assert again == a


def moved(slack: float, shards: int, virtual: int = 64) -> tuple[float, float]:
    """(share of rows that one more shard moves, largest load over the mean) with 65,536 cells of one to five rows."""
    counts = {c: 1 + hash((c, 7)) % 5 for c in range(1 << sharding.CELL_BITS)}

    def owners(n):
        at, out, loads = Counter(), [], Counter()
        for cell, until, shard, _ in sharding.bounded_pieces(counts, n, virtual, slack):
            out += [shard] * (until - at[cell])
            loads[shard] += until - at[cell]
            at[cell] = until
        return out, max(loads.values()) * n / sum(loads.values())

    (a, _), (b, most) = owners(shards), owners(shards + 1)
    return sum(x != y for x, y in zip(a, b, strict=True)) / len(a), most


def test_a_further_shard_moves_few_rows_and_fewer_with_slack():
    exact, loose = moved(1.0, 40), moved(1.25, 40)
    assert exact[1] < 1.001 and loose[1] < 1.251
    assert exact[0] < 0.30 and loose[0] < 0.06  # a hash modulo the count would move 40 of 41


def test_an_id_of_many_rows_is_ranked_in_lots(spark):
    docs = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("doc_id"))
    for slack in (1.0, 1.5):
        got = sharding.assign_shards(docs, [F.col("doc_id")], shards=6, slack=slack).collect()
        assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in docs.collect())
        for s in range(6):
            slots = sorted(r.slot for r in got if r.shard == s)
            assert slots == list(range(len(slots))) and len(slots) <= 4000 * slack / 6 + 1


def test_odd_rows(spark):
    docs = D.make(spark).drop("shard", "slot")
    got = sharding.assign_shards(docs, [F.col("doc_id"), F.crc32(F.coalesce("text", F.lit("")).cast("binary"))], shards=4).collect()
    assert len(got) == len(D.ROWS)
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert sharding.assign_shards(D.empty(spark), [F.col("doc_id")]).count() == 0


def test_intermediate_files_are_cleared_and_a_cluster_needs_a_shared_folder(spark):
    import os

    common.stored(spark.range(3), "some")
    folder = common.own_folder(spark).removeprefix("file://")
    assert os.listdir(folder)
    common.clear(spark)
    assert not os.path.exists(folder)

    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:  # noqa: N801
            get = staticmethod(lambda name, other: other)

    with pytest.raises(ValueError):
        common.shared_dir(Cluster)
