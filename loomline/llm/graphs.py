"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (u, v): the same label just within a component.

    Each round every node moves twice to the first of itself and its neighbours, and edges
    move along; an image of a connected graph is connected. Two rounds in three go by
    node id, which folds stars at once; every third by a hash of the round, which takes a
    constant part of any long path, so a logarithm of rounds suffices. Labels are nodes of
    the component. Each round's state is a written table.
    """
    both = lambda e: e.union(e.select("v", "u"))
    live = stored(edges.select("u", "v").where("u <> v").distinct(), "edges")
    labels = stored(both(live).select(F.col("u").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    rounds = 0
    while not live.isEmpty():
        key = lambda c: F.struct((F.xxhash64(c, F.lit(rounds)) if rounds % 3 == 2 else F.col(c)).alias("k"), F.col(c).alias("id"))  # noqa: E731, B023
        steps = stored(both(live).groupBy("u").agg(F.least(F.min(key("v")), F.min(key("u")))["id"].alias("to")), "steps")
        further = steps.toDF("_at", "_to")
        moves = stored(steps.join(further, steps["to"] == further["_at"]).select("u", F.col("_to").alias("to")), "moves")
        labels = stored(labels.join(moves, labels["label"] == moves["u"], "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        to_u, to_v = moves.toDF("u", "tu"), moves.toDF("v", "tv")
        live = stored(live.join(to_u, "u").join(to_v, "v").select(F.col("tu").alias("u"), F.col("tv").alias("v")).where("u <> v").distinct(), "edges")
        rounds += 1
    return labels
