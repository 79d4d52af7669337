"""The registered queries on tiny tables, against SQL where there is some, and the fitted parts against independent solutions."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from loomline.llm import driver_queries, mixing, quality, toxicity
from tests.llm import docs as D
from tests.test_driver_queries import TABLES, rows

COLUMNS = {
    "op1_entropy_mix": "doc_id size source_size target taken",
    "op2_min_cut_text": "page_id url text n_chars",
    "op3_ratio_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op4_binary_records": "doc_id start n_tokens ids_crc32",
    "op5_power_of_two_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op6_block_max_search": "query_id doc_id score rank",
    "op7_chain_toxicity": "doc_id held_out score predicted",
    "op8_bounded_ring": "doc_id size text_crc32 law shard slot grown_shard",
    "op9_token_counts": "doc_id n_bytes n_tokens over_limit",
    "op10_vertical_jaccard": "doc_id n_shingles component_id",
    "op11_source_divergence": "lang source part item value rank",
    "op12_importance_resampling": "doc_id n_features weight score rank",
    "op13_learned_partitions": "query_id rank vec_id score",
    "pipeline": "doc_id start length ids_crc32 doc_tokens sequence_id offset ids",
}
#: Queries that do not give a row for each row of their table.
OTHER_GRAIN = ("op5_power_of_two_packing", "op6_block_max_search", "op11_source_divergence", "op13_learned_partitions", "pipeline")


@pytest.fixture(scope="module")
def tiny(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tiny"))
    D.make(spark).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 1), (4, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    page = "<nav>m</nav><article><p>One article of some words, and of more than a few of them.</p></article>"
    spark.createDataFrame([(1, "u", page), (1, "u", page), (2, None, None), (None, "v", "")], "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([(1, "the quick brown fox"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], None), (None, [1.0, 1.0], 1), (2, None, 1), (2, [float("nan"), 1.0], 1)], "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="module")
def nothing(spark, tiny, tmp_path_factory):
    """The same tables without rows."""
    folder = str(tmp_path_factory.mktemp("nothing"))
    for name in ("documents", "labels", "pages", "benchmark", "embeddings"):
        spark.read.parquet(f"{tiny}/{name}.parquet").limit(0).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_registered_queries_on_empty_tables(spark, nothing, name):
    assert driver_queries.QUERIES[name](spark, nothing).count() == 0


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_registered_queries_on_odd_rows(spark, tiny, name):
    got = driver_queries.QUERIES[name](spark, tiny)
    assert set(COLUMNS[name].split()) <= set(got.columns)
    found = got.collect()
    if name not in OTHER_GRAIN:
        assert len(found) == (4 if name.startswith("op2_") else len(D.ROWS))


@pytest.mark.parametrize("name", ["quality_base_counts", "ring_loads", "mix_sizes", "op11_source_divergence", "op12_importance_resampling", "neighbour_counts"])
def test_queries_match_sql(spark, sf_dir, name):
    import pandas as pd

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = driver_queries.QUERIES[name](spark, sf_dir), con.execute(driver_queries.ORACLES[name]).to_arrow_table()
    assert sorted(got.columns) == sorted(want.column_names)
    assert rows(pd.DataFrame(map(tuple, got.collect()), columns=got.columns, dtype=object)) == rows(pd.DataFrame(want.to_pylist(), columns=want.column_names, dtype=object))


def test_rates_solve_the_dual(spark):
    rng = random.Random(4)
    hist = [(s, z, rng.randint(1, 40)) for s in "abc" for z in (3, 10, 25, 80, 200)]
    df = spark.createDataFrame(hist, "source string, size long, n long")
    sources = mixing.source_targets(df, (1, 2, 3), 3.0)
    by_source = {r.source: r for r in sources.collect()}
    keyed = df.join(sources.select("source", "r"), "source").select("r", "size", "n")
    found = {r.r: r.l for r in mixing.solve(keyed, sources, 3.0).collect()}
    for s, row in by_source.items():
        part = [(z, n) for t, z, n in hist if t == s]
        words = lambda x: sum(n * z * min(3.0, math.exp(x * z / row.mean)) for z, n in part)  # noqa: B023, E731
        low, high = -60.0, 60.0
        for _ in range(200):  # the words taken grow with the multiplier
            middle = (low + high) / 2
            low, high = (middle, high) if words(middle) < row.target else (low, middle)
        assert words(found[row.r]) == pytest.approx(row.target, rel=1e-5)
        if row.target < 3 * row.source_size * 0.999:
            assert found[row.r] == pytest.approx(low, abs=1e-3)


def test_the_ratio_is_that_of_smoothed_counts(spark, monkeypatch):
    rng = random.Random(6)
    texts = [(i, " ".join(rng.choice(["a", "b", "c", "d"]) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 60, 3)], "doc_id long, quality int")
    ratio = quality.fit_ratio(docs, labels)
    grams = {i: [*t.split(), *zip(t.split(), t.split()[1:], strict=False)] for i, t in texts}
    names = sorted({g for x in grams.values() for g in x}, key=str)
    hashed = spark.createDataFrame([(str(k), g if isinstance(g, str) else g[0], None if isinstance(g, str) else g[1]) for k, g in enumerate(names)], "k string, a string, b string")
    where = {int(r.k): r.h for r in hashed.select("k", F.pmod(F.when(F.col("b").isNull(), F.xxhash64("a")).otherwise(F.xxhash64("a", "b")), F.lit(quality.BUCKETS)).alias("h")).collect()}
    bucket = {g: where[k] for k, g in enumerate(names)}
    count = lambda ids, h: sum(bucket[g] == h for i in ids for g in grams[i])
    everyone, trusted = range(60), range(0, 60, 3)
    total = lambda ids: sum(len(grams[i]) for i in ids) + quality.BUCKETS
    for h in set(bucket.values()):
        assert ratio[h] == pytest.approx(math.log((count(trusted, h) + 1) / total(trusted)) - math.log((count(everyone, h) + 1) / total(everyone)))


def test_gradient_of_the_chain_by_finite_differences():
    rng = np.random.default_rng(8)
    x, seen = rng.integers(0, 4, (5, 6, 2)), np.ones((5, 6), bool)
    seen[1, 4:] = seen[3, 2:] = False
    y = rng.integers(0, 2, (5, 6)) * seen
    theta = rng.normal(size=4 + 5)
    theta[0] = 0.0

    def loss(v):
        weights, (bias, t01, t10, t11, start) = v[:4], v[4:]
        moves, total = np.array([[0.0, t01], [t10, t11]]), 0.0
        for words, labels, known in zip(x, y, seen, strict=True):
            emit = weights[words].sum(-1) + bias
            n = int(known.sum())
            scores = []
            for path in range(1 << n):
                bits = [path >> i & 1 for i in range(n)]
                scores.append(sum(e * b for e, b in zip(emit, bits, strict=False)) + start * bits[0] + sum(moves[a, b] for a, b in zip(bits, bits[1:], strict=False)))
            own = sum(e * b for e, b in zip(emit, labels[:n], strict=False)) + start * labels[0] + sum(moves[a, b] for a, b in zip(labels[:n], labels[1:n], strict=False))
            total += np.logaddexp.reduce(scores) - own
        return total / len(x)

    got = toxicity.gradient(theta, x, y, seen, 3)
    for i in range(1, len(theta)):
        step = 1e-5 * np.eye(len(theta))[i]
        assert got[i] == pytest.approx((loss(theta + step) - loss(theta - step)) / 2e-5, abs=1e-6)


def test_base_counts_are_those_of_the_judgement_and_fit_nothing(spark, monkeypatch, tmp_path):
    texts = ["a b c d e f g h " * 4, " \t\n", None, "", "x\nx\n\n x", "\x0bone two\r\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    want = sorted(quality.judge(docs, labels).select(*names).collect())
    monkeypatch.setattr(quality, "fit_ratio", None)
    assert sorted(driver_queries.QUERIES["quality_base_counts"](spark, str(tmp_path)).collect()) == want
