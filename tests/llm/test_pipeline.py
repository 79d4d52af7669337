import os
import random
import subprocess
import sys
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from loomline.llm.tokens import load_tokenizer
from tests.llm.test_other_operators import brute_components, brute_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(13)
    vocabulary = [f"{a}{b}" for a in ("ri", "sto", "li", "wa", "no", "ha") for b in ("ver", "ne", "ght", "ter", "se", "nd")]
    rows, labels = [], []
    for i in range(240):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(30, 80))]
        toxic = int(i % 6 == 0)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["idiot", "loser"]))
        rows.append((i, " ".join(words), "en", f"s{i % 3}", None))
        labels.append((i, 1, toxic))
    for i in range(30):  # near copies of clean documents
        words = rows[1 + 6 * (i % 5)][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((300 + i, " ".join(words), "en", "s1", None))
        labels.append((300 + i, 1, 0))
    rows += [(400, None, None, None, None), (401, "", "en", "s0", 0), (402, "too short", "en", "s0", 9), (403, "again and again " * 40, "en", "s0", None)]
    return rows, labels


def test_stages_against_brute_force(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{i}")
        columns, docs = docs.columns, spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs.collect())
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    good, clean, single, mixed, packed = seen
    passes = {r[0] for r in rows if (c := brute_counts(r[1]))[0] >= 20 and 100 * c[4] <= 30 * c[0]}
    assert {r.doc_id for r in good} <= passes and len(good) >= 0.95 * len(passes)
    toxic = {d for d, _, t in labels if t}
    assert {r.doc_id for r in clean} == {r.doc_id for r in good} - toxic
    assert len(single) == brute_components([(r.doc_id, r.text) for r in clean])[1] and {r.doc_id for r in single} <= {r.doc_id for r in clean}
    copies = Counter(r.doc_id for r in mixed)
    assert set(copies) <= {r.doc_id for r in single} and max(copies.values()) <= 3
    ids = load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in single}
    want = sum(n * (len(ids.encode(text[d], add_special_tokens=False).ids) + 1) for d, n in copies.items())
    assert sum(r.length for r in packed) == want and sorted(r.sequence_id for r in packed) == list(range(len(packed)))
    assert [r for r in docs.select(F.max("length")).first()][0] <= 4096


def test_columns_whose_names_clash_keep_their_values(spark, tmp_path):
    rows, labels = corpus()
    clashing = ["size", "n_words", "kept", "toxicity", "toxic_spans", "target", "copies", "source_size", "_hash", "_bin", "_copy", "_rank", "_rest", "_q", "_stays", "quality_score", "label", "node", "odd `name`-1", "c0"]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) for c in clashing})
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        assert docs.columns == columns and docs.count()
        for r in docs.collect():
            assert [r[c] for c in clashing] == [f"{c}:{r.doc_id}" for c in clashing]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0


def test_stages_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, spark.createDataFrame([], SCHEMA), str(tmp_path)).count() == 0


@pytest.mark.parametrize("absent", ["loomline.llm", "xxhash", "public_tokenizers", "corpus_pipeline"])
def test_other_queries_are_there_without_what_the_operators_need(absent):
    """In a process of its own, in which a module cannot be imported."""
    code = f"""import sys
sys.modules[{absent!r}] = None
import __spark_entry__ as e
print(len(e.queries()), "pipeline" in e.queries(), sum(n.startswith("op") for n in e.queries()), len(e.oracle_sql()))"""
    folder = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    n, pipeline, operators, oracles = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.split()
    assert int(n) >= 40 and pipeline == "False" and int(oracles) >= 40 and (int(operators) == 0) == (absent != "corpus_pipeline")


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
