"""The queries opN_<name> of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomline.llm import counting, divergence, html, jaccard, mixing, neighbours, packing, quality, records, resampling, search, sharding, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op4_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index = records.encode_to_records(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return index.select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2, longest=4096)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")


@query
def op8_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = sharding.assign_shards(sized, [F.col("doc_id"), F.col("text_crc32")], shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counting.count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


@query
def op1_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), weights=(1, 2, 3), cap=3)
    return mixed.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies")


@query
def op2_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
    return texts.select(F.col("page_id").cast("long").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op3_ratio_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.select(F.col("doc_id").cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality_score")


@query
def op7_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = toxicity.score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


ORACLES["op10_vertical_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
met AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM met JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (SELECT doc_id AS origin, doc_id AS place FROM words UNION SELECT origin, v FROM reach JOIN both_ways ON place = u)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.place) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id JOIN reach r ON r.origin = w.doc_id GROUP BY w.doc_id, s.n
"""


@query
def op10_vertical_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(documents(spark, sf_dir), k=5, percent=80)


@query
def op6_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return search.top_k(docs, docs.where(search.every_fiftieth(F.col("doc_id"))), k=10)


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


WORDS_SQL = r"words AS (SELECT doc_id, source, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)"

ORACLES["quality_base_counts"] = rf"""
WITH {WORDS_SQL},
eights AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM words WHERE len(w) >= 8)),
repeated AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM eights),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM repeated, (SELECT unnest(range(8)) AS o) WHERE n > 1 GROUP BY doc_id),
lines AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM words)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  len(w) < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * len(w) AS base_failed
FROM words JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
"""


@query
def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op3's judgement that do not depend on the fitted ratio, which is not fitted for them."""
    return quality.counted(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


ORACLES["ring_loads"] = """
SELECT CAST(shard AS INTEGER) AS shard, n // 40 + CASE WHEN shard < n % 40 THEN 1 ELSE 0 END AS n_rows, n // 40 + CASE WHEN shard < n % 40 THEN 1 ELSE 0 END - 1 AS last_slot
FROM (SELECT count(*) AS n FROM documents), (SELECT unnest(range(40)) AS shard) WHERE n >= 40
"""


@query
def ring_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law of op8: rows of each shard, and its last slot."""
    return op8_bounded_ring(spark, sf_dir).groupBy("shard").agg(F.count(F.lit(1)).alias("n_rows"), F.max("slot").alias("last_slot"))


ORACLES["mix_sizes"] = f"""
WITH {WORDS_SQL} SELECT doc_id, CAST(len(w) AS BIGINT) AS size, CAST(sum(len(w)) OVER (PARTITION BY source) AS BIGINT) AS source_size, true AS within FROM words
"""


@query
def mix_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op1 does not fit: sizes, and that no document is taken more than three times."""
    mixed = op1_entropy_mix(spark, sf_dir)
    return mixed.select("doc_id", "size", "source_size", F.col("taken").between(0, 3 * F.col("size")).alias("within"))


ORACLES["op11_source_divergence"] = r"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
terms AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts),
kept AS (SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
langs AS (SELECT l.lang, count(k.term) AS v, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang FROM texts) l LEFT JOIN kept k ON k.lang = l.lang GROUP BY l.lang),
counts AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM terms t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
groups AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total FROM (SELECT DISTINCT lang, source FROM texts) g LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
shares AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (g.total + 5 * l.v) AS BIGINT) AS p, CAST(1 + (1000000000 * (k.n + 5)) // (l.total + 5 * l.v) AS BIGINT) AS q
  FROM groups g JOIN langs l ON l.lang = g.lang JOIN kept k ON k.lang = g.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir), least_docs=30, top=50)


#: The checksum's table by its rule, a byte of the remainder at a time.
ORACLES["op12_importance_resampling"] = r"""
WITH RECURSIVE steps AS (SELECT i AS b, CAST(i AS UBIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
both_tables AS (SELECT true AS own, doc_id AS id, row_number() OVER () AS r, text FROM documents UNION ALL SELECT false, item_id, -row_number() OVER (), text FROM benchmark),
words AS (SELECT own, id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM both_tables),
grams AS (SELECT own, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g FROM words),
features AS (SELECT own, r, g, count(*) AS n FROM grams GROUP BY ALL),
names AS (SELECT g, CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(0, octet_length(encode(g))), lambda i: CAST('0x' || substr(hex(encode(g)), 2 * i + 1, 2) AS UBIGINT))),
    lambda c, b: xor(t[CAST(xor(c, b) & 255 AS BIGINT) + 1], c >> 8)), 4294967295::UBIGINT) % 10000 AS BIGINT) AS bucket FROM (SELECT DISTINCT g FROM features), crc),
counts AS (SELECT bucket, coalesce(sum(n) FILTER (own), 0) AS s, coalesce(sum(n) FILTER (NOT own), 0) AS t FROM features JOIN names USING (g) GROUP BY bucket),
sums AS (SELECT sum(s) AS ss, sum(t) AS tt FROM counts),
gains AS (SELECT bucket, CAST(floor(1000 * ln(CAST(t + 1 AS DOUBLE) * CAST(ss + 10000 AS DOUBLE) / (CAST(s + 1 AS DOUBLE) * CAST(tt + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM counts, sums),
weights AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM features JOIN names USING (g) JOIN gains USING (bucket) WHERE own GROUP BY r),
scored AS (SELECT w.r, id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM words w LEFT JOIN weights x ON x.r = w.r WHERE own),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 5 * count(*) OVER () // 100 AS k FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= k THEN rank END AS rank FROM scored LEFT JOIN ranked USING (r)
"""


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), neighbours.every_twentieth(F.col("vec_id")), k=20)


ORACLES["neighbour_counts"] = """
SELECT vec_id AS query_id, least(20, (SELECT count(*) FROM embeddings) - 1) AS n_found, true AS in_order FROM embeddings WHERE vec_id % 20 = 0
"""


@query
def neighbour_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op13 does not depend on the partitions: how many every query finds, ranked without a gap and nearest first."""
    over = Window.partitionBy("query_id").orderBy("rank")
    placed = op13_learned_partitions(spark, sf_dir).withColumn("_fits", (F.row_number().over(over) == F.col("rank")) & F.coalesce(F.lag("score").over(over) >= F.col("score"), F.lit(True)))
    return placed.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_found"), F.bool_and("_fits").alias("in_order"))
