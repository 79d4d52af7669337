"""Nearest neighbours by learned partitions: a balanced cut of a neighbour graph, and a classifier that routes.

A bounded sample of vectors is joined into a graph of exact nearest neighbours, and the
graph is cut into parts of nearly equal size with few edges between them. A linear
softmax classifier learns from a vector to tell the parts that its neighbours are in. It
then places every vector of the table in its likeliest part, and sends every query to the
several likeliest; how many is set on sample rows that the classifier was not fitted on, so
that they meet TARGET of their neighbours. Vectors met are compared by exact inner products.

Equal vectors are one row of the index, with their k + 1 least ids: no other of their ids
can be among k results. Index and queries meet in blocks of bounded size within a part, so
that a part with a third of all vectors is many tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import stored

#: What is fitted: vectors of the sample, those of them held out to set the probes, neighbours a vector in the graph, parts at most.
FIT_ROWS, HELD_OUT, DEGREE, PARTS = 8192, 1024, 10, 32
#: The share of held-out rows' neighbours that the probed parts are to hold.
TARGET = 0.95
#: Sizes of parts may differ from their mean by so much, and rounds of refinement.
IMBALANCE, ROUNDS = 0.05, 20
STEPS, RATE, DECAY = 150, 0.1, 1e-4
#: Index rows and queries of a block at most, and queries compared at once.
BLOCK, STEP = 8192, 128
#: A product of matrices may differ from the sum in order by so much of the largest score.
SLACK = 1e-9
#: Groups of equal vectors are cut to their least ids by steps of so many salts to one.
FOLD, SALTS = 8, 512


def every_twentieth(vec_id: Column) -> Column:
    return F.coalesce(F.pmod(vec_id, F.lit(20)) == 0, F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, vector, h1, h2): one row for each vec_id with a vector that takes part, and two hashes that identify the vector."""
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(x))
    some = F.exists("embedding", lambda x: x != 0)
    rows = table.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite & some).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    # Zeros of either sign are one value.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + 0.0))
    one = rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    return one.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), "vector")})


def least_ids(rows: DataFrame, k: int) -> DataFrame:
    """The rows, without those of a vector that has k rows of lesser vec_id. Groups of more than k go by salted steps, so that none meets in one task."""
    hot = stored(rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > k), "hot-vectors")
    if hot.isEmpty():
        return rows
    left = rows.join(hot, ["h1", "h2"]).drop("_n")
    salts = SALTS
    while salts >= 1:
        over = Window.partitionBy("h1", "h2", F.pmod(F.xxhash64("vec_id"), F.lit(salts))).orderBy("vec_id")
        left = left.withColumn("_rank", F.row_number().over(over)).where(F.col("_rank") <= k).drop("_rank")
        salts //= FOLD
    return rows.join(hot, ["h1", "h2"], "left_anti").unionByName(left)


def neighbour_lists(session, sample: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each vector of the sample, by tasks that each hold the sample."""
    shared = session.sparkContext.broadcast(sample)

    def scan(batches):
        own = shared.value
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for at in range(0, len(ids), STEP):
                some = ids[at : at + STEP]
                score = own[some] @ own.T
                score[np.arange(len(some)), some] = -np.inf
                best = np.argpartition(-score, k - 1, axis=1)[:, :k]
                order = np.take_along_axis(-score, best, 1).argsort(axis=1, kind="stable")
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(list(np.take_along_axis(best, order, 1)))], ["id", "near"])

    found = session.range(len(sample)).mapInArrow(scan, "id long, near array<long>").collect()
    lists = np.zeros((len(sample), k), np.int64)
    for r in found:
        lists[r["id"]] = r["near"]
    return lists


def grown(near: np.ndarray, parts: int) -> np.ndarray:
    """A first cut: each part grows from a node along the edges until it is full."""
    n = len(near)
    own, part, queue, seed = np.full(n, -1), 0, [], 0
    size, full = 0, -(-n // parts)
    for _ in range(n):
        node = -1
        while queue and node < 0:
            first = queue.pop(0)
            node = first if own[first] < 0 else -1
        while node < 0:
            node, seed = (seed, seed + 1) if own[seed] < 0 else (-1, seed + 1)
        own[node], size = part, size + 1
        queue.extend(int(x) for x in near[node] if own[x] < 0)
        if size == full:
            part, size, queue = part + 1, 0, []
    return own


def balanced_parts(near: np.ndarray, parts: int) -> np.ndarray:
    """The part of each node: a cut of the graph into parts of nearly equal size, refined by moves that cut fewer edges."""
    n = len(near)
    own = grown(near, parts)
    ends = np.concatenate([np.repeat(np.arange(n), near.shape[1]), near.ravel()]), np.concatenate([near.ravel(), np.repeat(np.arange(n), near.shape[1])])
    most, least = int(np.ceil((1 + IMBALANCE) * n / parts)), int((1 - IMBALANCE) * n / parts)
    for _ in range(ROUNDS):
        met = np.bincount(ends[0] * parts + own[ends[1]], minlength=n * parts).reshape(n, parts)
        best = met.argmax(axis=1)
        gain = met[np.arange(n), best] - met[np.arange(n), own]
        sizes, moved = np.bincount(own, minlength=parts), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[best[i]] < most and sizes[own[i]] > least:
                sizes[own[i]] -= 1
                sizes[best[i]] += 1
                own[i] = best[i]
                moved += 1
        if moved < n // 1000 + 1:
            break
    return own


class Router:
    """The classifier's weights; numpy arrays of fixed size."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    @staticmethod
    def inputs(vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.concatenate([unit, np.ones((len(unit), 1))], axis=1)

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        return self.inputs(vectors) @ self.weights

    @classmethod
    def fit(cls, vectors: np.ndarray, wanted: np.ndarray) -> Router:
        """Softmax regression on shares of parts, by Adam steps on all rows."""
        x = cls.inputs(vectors)
        w = np.zeros((x.shape[1], wanted.shape[1]))
        first, second = np.zeros_like(w), np.zeros_like(w)
        for t in range(1, STEPS + 1):
            z = x @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            slope = x.T @ (p - wanted) / len(x) + DECAY * w
            first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
            w -= RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
        return cls(w)


def learn(session, sample: np.ndarray, k: int) -> tuple[Router, int]:
    """(the classifier, how many parts a query is sent to), from a sample of different vectors in random order."""
    n = len(sample)
    parts = max(1, min(PARTS, n // (4 * k)))
    if parts == 1:
        return Router(np.zeros((sample.shape[1] + 1, 1))), 1
    near = neighbour_lists(session, sample, min(max(DEGREE, k), n - 1))
    own = balanced_parts(near[:, :DEGREE], parts)
    shares = np.zeros((n, parts))
    np.add.at(shares, (np.repeat(np.arange(n), DEGREE), own[near[:, :DEGREE].ravel()]), 1.0)
    shares[np.arange(n), own] += 1.0
    held = min(HELD_OUT, n // 4)
    router = Router.fit(sample[held:], shares[held:] / shares[held:].sum(axis=1, keepdims=True))
    placed = router.logits(sample).argmax(axis=1)
    order = np.argsort(-router.logits(sample[:held]), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(held, 0), 1)
    # At which probe the part of each neighbour is reached.
    reached = np.take_along_axis(place, placed[near[:held, :k]], 1)
    met = np.bincount(reached.ravel(), minlength=parts).cumsum() / reached.size
    return router, int(np.searchsorted(met, TARGET - 1e-12)) + 1


def compare(queries: pa.Table, rows: pa.Table, dim: int, k: int) -> pa.Table:
    """(h1, h2, vec_id, score) of the k best ids of a block for each query of a block, ties to the lesser id."""
    q, c = matrix(queries["vector"], dim), matrix(rows["vector"], dim)
    h1, h2 = queries["h1"].to_numpy(), queries["h2"].to_numpy()
    lists = rows["ids"].combine_chunks()
    ids, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
    counts = np.diff(ends, prepend=0)
    out = []
    for at in range(0, len(q), STEP):
        some = q[at : at + STEP]
        score = some @ c.T
        kth = np.partition(score, len(c) - min(k, len(c)), axis=1)[:, len(c) - min(k, len(c))]
        a, b = np.nonzero(score >= (kth - SLACK * np.abs(score).max(axis=1))[:, None])
        # Component by component in order, so that equal vectors tie.
        exact = np.zeros(len(a))
        for j in range(dim):
            exact += some[a, j] * c[b, j]
        n = counts[b]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(ends[b] - n, n)
        a, exact, found = np.repeat(a, n), np.repeat(exact, n), ids[place]
        order = np.lexsort((found, -exact, a))
        a, exact, found = a[order], exact[order], found[order]
        first = np.searchsorted(a, a)
        keep = np.arange(len(a)) - first < k
        out.append((h1[at + a[keep]], h2[at + a[keep]], found[keep], exact[keep]))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)]
    return pa.table([pa.array(x) for x in columns], ["h1", "h2", "vec_id", "score"])


def dealt(counts: dict[int, int], least: int) -> dict[int, int]:
    """How many blocks each part's rows are dealt into: a part of more than its share, or than BLOCK, is several."""
    size = min(BLOCK, max(least, -(-sum(counts.values()) // max(1, len(counts)))))
    return {p: max(1, -(-n // size)) for p, n in counts.items()}


def block_numbers(rows: DataFrame, blocks: dict[int, int], others: dict[int, int], own: str, other: str) -> DataFrame:
    """The rows in their own block of their part, once for each block of the other side."""
    look = lambda x: F.element_at(F.create_map(*[F.lit(v) for pair in sorted(x.items()) for v in pair]), F.col("part"))
    placed = rows.withColumn(own, F.pmod(F.col("h2"), look(blocks)).cast("int"))
    return placed.withColumn(other, F.explode(F.sequence(F.lit(0), look(others) - 1)))


def search(table: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for every row of the table that is a query.

    ``table`` has vec_id and embedding; ``is_query`` is a condition on vec_id. Nearness is
    the inner product in double precision; ties go to the lesser vec_id. A query's own id
    is no candidate. Rows take no part, on either side, whose vec_id or vector is null, or
    whose vector is all zero, empty, or holds a null or a component that is not finite; nor do those
    of another dimension than most have (the least, of several). Of rows with the same vec_id
    the one with the least vector counts, so repeated rows count once. Fewer than k
    candidates are all returned. Without queries, or rows, there is no result. Other columns are not read.
    """
    session = table.sparkSession
    nothing = session.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    every = stored(usable(table), "vectors")
    # One row for each length of vectors.
    lengths = every.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "dim").first()
    if lengths is None:
        return nothing
    dim = lengths["dim"]
    rows = every.where(F.size("vector") == dim)
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "h1", "h2")
    different = stored(least_ids(rows, k + 1).groupBy("h1", "h2").agg(F.first("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")), "different-vectors")
    sample = np.array([r["vector"] for r in different.orderBy("h1", "h2").limit(FIT_ROWS).select("vector").collect()])
    router, probes = learn(session, sample, k)
    shared = session.sparkContext.broadcast(router.weights)

    def place(batches):
        own = Router(shared.value)
        for batch in batches:
            parts = own.logits(matrix(batch.column("vector"), dim)).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts)], [*batch.schema.names, "part"])

    index = stored(different.mapInArrow(place, "h1 long, h2 long, vector array<double>, ids array<long>, part int"), "index")
    # One row a part.
    held = {r["part"]: (r["n"], r["rows"]) for r in index.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("rows")).collect()}
    ids_in = np.array([held.get(p, (0, 0))[1] for p in range(router.weights.shape[1])])

    def route(batches):
        own = Router(shared.value)
        for batch in batches:
            if not len(batch):
                continue
            order = np.argsort(-own.logits(matrix(batch.column("vector"), dim)), axis=1, kind="stable")
            # Parts of few rows: on to the next ones until k ids and the query's own are met.
            upto = np.maximum(probes, (ids_in[order].cumsum(axis=1) < k + 1).sum(axis=1) + 1)
            sent = np.arange(order.shape[1])[None, :] < upto[:, None]
            at, column = np.nonzero(sent)
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(order[at, column].astype(np.int32))], [*taken.schema.names, "part"])

    asked = different.select("h1", "h2", "vector").join(queries.select("h1", "h2").distinct(), ["h1", "h2"], "left_semi")
    routed = stored(asked.mapInArrow(route, "h1 long, h2 long, vector array<double>, part int").where(F.col("part").isin(sorted(held))), "routed")
    sent = {r["part"]: r["n"] for r in routed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sent:
        return nothing
    blocks = dealt({p: n for p, (n, _) in held.items() if p in sent}, 256)
    lots = dealt(sent, 256)
    right = block_numbers(index.where(F.col("part").isin(sorted(sent))), blocks, lots, "block", "lot").groupBy("part", "block", "lot")
    left = block_numbers(routed, lots, blocks, "lot", "block").groupBy("part", "block", "lot")

    def meet(asked: pa.Table, rows: pa.Table) -> pa.Table:
        if not len(asked) or not len(rows):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], ["h1", "h2", "vec_id", "score"])
        return compare(asked, rows, dim, k + 1)

    met = left.cogroup(right).applyInArrow(meet, "h1 long, h2 long, vec_id long, score double")
    best = Window.partitionBy("h1", "h2").orderBy(F.col("score").desc(), "vec_id")
    top = met.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") <= k + 1).drop("_rank")
    own = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    found = queries.join(top, ["h1", "h2"]).where("query_id <> vec_id").withColumn("rank", F.row_number().over(own))
    return found.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
