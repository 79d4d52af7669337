"""Source divergence, importance resampling and learned partitions against brute force, on odd rows and hot groups."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import divergence, neighbours, resampling, selection
from tests.llm import docs as D

SCHEMA = "doc_id long, text string, lang string, source string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_audit(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        number = Counter(t for d in own for t in set(d[2]))
        kept = {t for t, n in number.items() if n >= least}
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in own}}
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))  # noqa: B023, E731
        whole = sum(counts.values(), Counter())
        for s, c in counts.items():
            pairs = [(-sum(abs(share(c, t) - share(x, t)) for t in kept), o.encode(), o) for o, x in counts.items() if o != s]
            terms = [(share(whole, t) - share(c, t), t.encode(), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)}
    return out


def audit_rows(n=300):
    rng = random.Random(3)
    terms = ["Ab", "aB", "ça", "ÇA", "日本", "x" * 40, "x" * 41, *[f"t{chr(97 + i)}" for i in range(20)]]
    rows = [(i, " ".join(rng.choices(terms, k=rng.randint(0, 12))), rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "s1", "S", "ß", None])) for i in range(n)]
    return [*rows, *rows[:40], (None, None, "en", "empty"), (7, "1 2 , 3", "xx", None), (8, "alone", "xx", None)]


@pytest.mark.parametrize("ties", [selection.TIES, 2])
def test_audit_against_brute_force(spark, monkeypatch, ties):
    monkeypatch.setattr(selection, "TIES", ties)
    rows = audit_rows()
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"term": F.lit(1), "p": F.lit(2), "value": F.lit(3), "rank": F.lit(4)})
    for least, top in ((30, 4), (1, 50), (10_000, 5)):
        got = divergence.audit(docs, least, top)
        assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
        found = [tuple(r) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == brute_audit(rows, least, top)
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_thresholds_by_digits(spark):
    rng = random.Random(9)
    rows = [(g, rng.choice([0, 5, 1 << 30, rng.randrange(1 << 31)])) for g in "abc" for _ in range(200)] + [("few", 7), ("few", 7)]
    df = spark.createDataFrame(rows, "g string, v long")
    got = {r.g: (r.threshold, r.need) for r in selection.group_thresholds(df, ["g"], "v", 31, 60).collect()}
    for g in "abc":
        values = sorted((v for h, v in rows if h == g), reverse=True)
        assert got[g] == (values[59], sum(v == values[59] for v in values[:60]))
    assert got["few"][0] == 7 and got["few"][1] >= 2


def test_single_key_by_digits(spark):
    rng = random.Random(10)
    rows = [(rng.choice([-3, 0, 9]), rng.choice([-(1 << 63), 5, (1 << 63) - 1, rng.randrange(1 << 40)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a long, b long")
    order = sorted(rows)
    for k in (1, 77, 250, 500):
        key, need = selection.kth_key(df, ["a", "b"], k)
        assert tuple(key) == order[k - 1] and need == k - sum(r < order[k - 1] for r in order)
    assert selection.kth_key(df, ["a", "b"], 501) is None and selection.kth_key(df, ["a", "b"], 0) is None


def brute_resample(rows, target, percent=5, least=20):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    s, t = Counter(b for _, x in rows for b in features(x)[1]), Counter(b for x in target for b in features(x)[1])
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * (sum(s.values()) + 10000) / (float(s[b] + 1) * (sum(t.values()) + 10000))))
    out = []
    for doc_id, text in rows:
        n, buckets = features(text)
        weight = sum(map(gain, buckets))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(buckets), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], -(1 << 63) if r[0] is None else r[0]))
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("percent", [5, 60, 100])
def test_resampling_against_brute_force(spark, percent):
    rng = random.Random(5)
    words = ["Alpha", "beta", "été", "x1", "日本", "gamma-delta", "o'clock", "new\nline"]
    rows = [(i if i % 50 else None, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(200)]
    rows += [(500, " ".join(words * 6))] * 70 + [(600, None), (601, ""), (602, D.LONG)]
    target = ["alpha beta gamma", "été x1 日本 alpha beta", None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("clash"), "_best": F.lit(1), "rank": F.lit(2), "weight": F.lit(3)})
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent)
    found = [(r.doc_id, r.n_words, r.n_features, r.weight, r.score) for r in got.collect()]
    want, drawn = brute_resample(rows, target, percent)
    assert Counter(found) == Counter(want)
    ranked = sorted((r for r in got.collect() if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.score, r.doc_id) for r in ranked] == [(d[4], d[0]) for d in drawn]


def test_resampling_of_empty_tables(spark):
    none, some = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert resampling.resample(none, some).count() == 0
    assert [tuple(r) for r in resampling.resample(some, none).select("n_features", "weight", "rank").collect()] == [(3, -2079, None)]


def nearest(vectors, k):
    """(score, id) lists by brute force; vectors is {id: list}."""
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids], dtype=np.float64)
    return {q: [(i, s) for s, i in sorted((-(np.add.accumulate(x[a] * x[b])[-1]), ids[b]) for b in range(len(ids)) if b != a)[:k]] for a, q in enumerate(ids) if q % 20 == 0}


def found_lists(got):
    lists = defaultdict(list)
    for r in sorted(got.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(lists[r.query_id]) + 1
        lists[r.query_id].append((r.vec_id, -r.score))
    return lists


SCHEMA_13 = "vec_id long, embedding array<float>, label int"


def test_search_on_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = {i: [float(i % 5), float(i % 3) - 1, 0.5] for i in range(60)} | {-20: [1.0, 0.0, -0.0], 60: [1.0, 0.0, 0.0]}
    rows = [(i, v, 0) for i, v in good.items()] + [(i, v, 1) for i, v in list(good.items())[:15]]
    rows += [(100, None, 0), (120, [0.0, 0.0, 0.0], 0), (140, [1.0, None, 2.0], 0), (160, [1.0, nan, 2.0], 0), (180, [inf, 1.0, 2.0], 0), (None, [9.0, 9.0, 9.0], 0), (200, [1.0], 0), (220, [], 0)]
    rows += [(40, [99.0, 99.0, 99.0], 0)]  # of two vectors of an id, the least counts
    table = spark.createDataFrame(rows, SCHEMA_13).withColumns({"part": F.lit("x"), "h1": F.lit("y"), "score": F.lit(1)})
    got = neighbours.search(table, neighbours.every_twentieth(F.col("vec_id")), k=20)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert found_lists(got) == nearest(good, 20)
    few = spark.createDataFrame([r for r in rows if r[0] in (0, 1, 20)], SCHEMA_13)
    assert {q: len(v) for q, v in found_lists(neighbours.search(few, neighbours.every_twentieth(F.col("vec_id")))).items()} == {0: 2, 20: 2}
    assert neighbours.search(spark.createDataFrame([], SCHEMA_13), neighbours.every_twentieth(F.col("vec_id"))).count() == 0
    assert neighbours.search(spark.createDataFrame(rows, SCHEMA_13).where("vec_id = 1"), neighbours.every_twentieth(F.col("vec_id"))).count() == 0


def clustered(n, dim, centres, seed):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    x = c[rng.integers(0, centres, n)] + 0.25 * rng.normal(size=(n, dim))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_recall_with_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "FIT_ROWS", 1500)
    x = clustered(3000, 16, 40, 1)
    x[rng := np.random.default_rng(2).permutation(3000)[:900]] = x[0]  # equal vectors, a third of all with row 0
    assert len(rng) == 900
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA_13)
    lists = found_lists(neighbours.search(table, neighbours.every_twentieth(F.col("vec_id")), k=20))
    want = nearest(dict(enumerate(x.astype(np.float64).tolist())), 20)
    assert set(lists) == set(want) and all(len(v) == 20 for v in lists.values())
    assert all(lists[q] == want[q] for q in want if (x[q] == x[0]).all())
    hits = sum(len({i for i, _ in lists[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_queries_leave_most_parts_of_clustered_data(spark):
    x = clustered(4000, 16, 60, 3).astype(np.float64)
    router, probes = neighbours.learn(spark, x, 20)
    assert router.weights.shape[1] == neighbours.PARTS and probes <= neighbours.PARTS // 3
    near = neighbours.neighbour_lists(spark, x, 10)
    own = neighbours.balanced_parts(near, neighbours.PARTS)
    sizes = np.bincount(own, minlength=neighbours.PARTS)
    assert sizes.max() <= math.ceil(1.05 * 4000 / neighbours.PARTS) and sizes.min() >= int(0.95 * 4000 / neighbours.PARTS) - 1
    cut = (own[near] != own[:, None]).mean()
    shuffled = np.random.default_rng(4).permutation(own)
    assert cut < 0.5 * (shuffled[near] != shuffled[:, None]).mean()
