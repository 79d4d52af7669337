"""Queries of the relational primitives over the driver's test tables, each beside its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomline.functions import nested, text
from loomline.operators import relational as rel
from loomline.operators.segments import gaps_and_islands
from loomline.streaming import arrivals

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None):
    """Register the function below under its own name, with its oracle if there is one."""

    def register(build):
        QUERIES[build.__name__] = build
        if oracle:
            ORACLES[build.__name__] = oracle
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_runs(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    out = gaps_and_islands(
        events,
        partition=["user_id"],
        order=["ts", "event_id"],
        change=["event_type"],
        segment="stint",
        firsts={"event_type": "event_type", "first_event": "event_id"},
        lasts={"last_event": "event_id", "end_value": "value"},
        distincts={"n_props": "props"},
        count="n_events",
        deltas={"value_delta": "end_value"},
        hot_rows=hot_rows,
    )
    return out.withColumn("value_delta", F.round("value_delta", 6))


@query("""
WITH marked AS (
  SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS brk
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg FROM marked),
segs AS (
  SELECT user_id, seg AS stint, arg_min(event_type, (ts, event_id)) AS event_type,
         arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event,
         arg_max(value, (ts, event_id)) AS end_value, count(*) AS n_events, count(DISTINCT props) AS n_props
  FROM numbered GROUP BY user_id, seg)
SELECT *, round(end_value - lag(end_value, 1, 0.0) OVER (PARTITION BY user_id ORDER BY stint), 6) AS value_delta FROM segs
""")
def stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of one event type per user, with first, last, count and the change of value."""
    return event_runs(table(spark, sf_dir, "events"))


@query("""
WITH hot AS (SELECT * REPLACE (CASE WHEN event_id % 10 < 9 THEN 0 ELSE user_id END AS user_id) FROM events),
marked AS (
  SELECT *, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS brk
  FROM hot WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, CAST(sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seg FROM marked),
segs AS (
  SELECT user_id, seg AS stint, arg_min(event_type, (ts, event_id)) AS event_type,
         arg_min(event_id, (ts, event_id)) AS first_event, arg_max(event_id, (ts, event_id)) AS last_event,
         arg_max(value, (ts, event_id)) AS end_value, count(*) AS n_events, count(DISTINCT props) AS n_props
  FROM numbered GROUP BY user_id, seg)
SELECT *, round(end_value - lag(end_value, 1, 0.0) OVER (PARTITION BY user_id ORDER BY stint), 6) AS value_delta FROM segs
""")
def stints_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same runs where one user has nine tenths of all events, segmented in slices of some thousand rows."""
    events = table(spark, sf_dir, "events").withColumn("user_id", F.when(F.col("event_id") % 10 < 9, F.lit(0)).otherwise(F.col("user_id")))
    return event_runs(events, hot_rows=2000)


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS stint_num
FROM lineitem
""")
def ordinal_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rank of each line in its order by ship date, ties by all else."""
    ties = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    ranked = rel.ordinal_rank(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_shipdate", ties, "stint_num")
    return ranked.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "stint_num")


@query("""
SELECT l_orderkey, substr(md5(string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY CAST(l_partkey AS VARCHAR))), 1, 16) AS set_key
FROM lineitem GROUP BY l_orderkey
""")
def set_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key of each order's parts that their order does not change."""
    parts = F.array_sort(F.collect_list(F.col("l_partkey").cast("string")))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.substring(F.md5(F.array_join(parts, "|").cast("binary")), 1, 16).alias("set_key"))


@query("""
SELECT c_name, array_to_string(list_sort(string_split(replace(array_to_string(list_filter(
         regexp_split_to_array(lower(c_name), '[^a-z0-9'']+'), lambda t: t NOT IN ('jr','sr','ii','iii','iv','v')), ''), '''', ''), '')), '') AS signature
FROM (SELECT DISTINCT c_name FROM customer)
""")
def letter_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name signatures of distinct names."""
    return text.name_signatures(table(spark, sf_dir, "customer"), "c_name").withColumnRenamed("name", "c_name")


@query(r"""
SELECT doc_id, nullif(regexp_extract(text, 'the (\w+)', 1), '') AS word_after, CAST(nullif(regexp_extract(text, '([0-9]{2})', 1), '') AS BIGINT) AS two_digits
FROM documents
""")
def regex_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First groups of patterns, null without a match."""
    return table(spark, sf_dir, "documents").select("doc_id", text.extract("text", r"the (\w+)").alias("word_after"), text.extract("text", r"([0-9]{2})", "bigint").alias("two_digits"))


@query("""
SELECT doc_id, coalesce(contains(text, 'token'), false) AS has_token, coalesce(contains(text, 'the ') AND contains(text, ' of'), false) AS has_both FROM documents
""")
def flag_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags by substring, false for null."""
    return table(spark, sf_dir, "documents").select("doc_id", text.has("text", "token").alias("has_token"), (text.has("text", "the ") & text.has("text", " of")).alias("has_both"))


@query("""
SELECT page_id, CAST(unnest(range(1, n + 1)) AS BIGINT) AS at, unnest(hrefs) AS href, unnest(labels) AS label
FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
             regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS labels, len(hrefs) AS n FROM pages)
""")
def html_extract_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor of every page with its target and label, in page order."""
    pattern = F.lit('<a href="([^"]*)">([^<]*)</a>')
    pairs = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("label"))
    rows = table(spark, sf_dir, "pages").select("page_id", F.posexplode(pairs).alias("_at", "_a"))
    return rows.select("page_id", (F.col("_at") + 1).cast("long").alias("at"), "_a.href", "_a.label")


@query("""
SELECT CAST(year(o_orderdate) AS BIGINT) AS season, count(*) AS n_games, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date,
       round(avg(CASE WHEN l.k IS NULL THEN 0 ELSE 1 END), 9) AS pct_in_lines, CAST(sum(CASE WHEN l.k IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS n_in_lines
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON o_orderkey = l.k GROUP BY 1
""")
def coverage_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per year, their dates, and the part that has lines."""
    members = {"in_lines": table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))}
    flagged = rel.presence_flags(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), "o_orderkey", members)
    date = F.to_date("o_orderdate")
    return flagged.groupBy(F.year("o_orderdate").cast("long").alias("season")).agg(
        F.count(F.lit(1)).alias("n_games"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
        F.round(rel.share(F.col("in_lines")), 9).alias("pct_in_lines"), F.sum(F.col("in_lines").cast("int")).alias("n_in_lines"),
    )


@query("""
SELECT l_orderkey, max(coalesce(l_quantity, 0)) AS best_quantity, max(coalesce(l_extendedprice, 0)) AS best_price,
       arg_min(l_returnflag, (l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS first_flag
FROM lineitem GROUP BY l_orderkey
""")
def final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest values of each order, and the flag of its first line."""
    first = F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    best = lambda c: F.max(F.coalesce(F.col(c), F.lit(0.0)))
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(best("l_quantity").alias("best_quantity"), best("l_extendedprice").alias("best_price"), F.min_by("l_returnflag", first).alias("first_flag"))


@query("SELECT l_suppkey, l_returnflag, count(DISTINCT l_orderkey) AS games FROM lineitem GROUP BY ALL")
def distinct_pairs_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders of each supplier and flag."""
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count_distinct("l_orderkey").alias("games"))


def nation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = {
        "in_customer": table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("n_nationkey")),
        "in_supplier": table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("n_nationkey")),
    }
    return rel.presence_flags(table(spark, sf_dir, "nation"), "n_nationkey", members)


NATION_FLAGS = """
SELECT n_nationkey, n_name, n_regionkey, n_nationkey IN (SELECT c_nationkey FROM customer) AS in_customer,
       n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 9000) AS in_supplier FROM nation
"""


@query(NATION_FLAGS)
def presence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with flags of the tables they occur in."""
    return nation_flags(spark, sf_dir)


@query(f"SELECT * FROM ({NATION_FLAGS}) WHERE in_supplier OR n_regionkey = 0 AND in_customer")
def any_flag_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with a flag of their own region or of suppliers."""
    own = nation_flags(spark, sf_dir).withColumn("in_own", F.col("in_customer") & (F.col("n_regionkey") == 0))
    return rel.any_flag(own, ["in_own", "in_supplier", "in_none"]).drop("in_own")


@query("""
SELECT o.o_orderkey, o.o_custkey, d.l_shipdate, d.l_returnflag, d.l_quantity FROM orders o LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1) d
ON o.o_orderkey = d.l_orderkey
""")
def left_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the detail of their first line, null where there is none."""
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    detail = rel.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order).select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate", "l_returnflag", "l_quantity")
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(detail, "o_orderkey", "left")


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1
""")
def keep_first_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first line of each order in an explicit order."""
    order = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return rel.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice")


@query("SELECT * FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49)")
def semi_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a large line."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_quantity > 49")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left_semi")


@query("SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def anti_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without lines."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left_anti")


@query("""
(SELECT 'built' AS side, c_nationkey AS k FROM customer EXCEPT SELECT 'built', s_nationkey FROM supplier WHERE s_acctbal > 5000)
UNION ALL (SELECT 'live', s_nationkey FROM supplier EXCEPT SELECT 'live', c_nationkey FROM customer WHERE c_acctbal > 9900)
""")
def set_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set differences both ways."""
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    built, _ = rel.differences(customers.select(F.col("c_nationkey").alias("k")), suppliers.where("s_acctbal > 5000").select("s_nationkey"))
    _, live = rel.differences(customers.where("c_acctbal > 9900").select(F.col("c_nationkey").alias("k")), suppliers.select(F.col("s_nationkey").alias("k")))
    tag = lambda df, side: df.select(F.lit(side).alias("side"), "k")
    return tag(built, "built").unionByName(tag(live, "live"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CAST(c_acctbal AS DOUBLE) AS balance, c_mktsegment AS segment, NULL AS phone FROM customer
UNION ALL SELECT s_name, s_name, CAST(s_suppkey AS DOUBLE), NULL, 'none' FROM supplier
""")
def relaxed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables with other columns and types as one: a number and a text id make a text id."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("balance"), F.lit("none").alias("phone"))
    return rel.relaxed_union([customers, suppliers])


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '1-URGENT'
UNION ALL SELECT o_orderkey, 'R', round(o_totalprice * 2, 2) FROM orders WHERE o_orderpriority = '1-URGENT'
""")
def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the urgent ones renewed."""
    orders = table(spark, sf_dir, "orders")
    renewed = orders.where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.lit("R").alias("o_orderstatus"), F.round(F.col("o_totalprice") * 2, 2).alias("o_totalprice"))
    return rel.upsert(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), renewed, ["o_orderkey"])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none.deeper') AS missing FROM events")
def json_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null-safe paths into JSON text."""
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.get_json_object("props", "$.none.deeper").alias("missing"))


@query("""
SELECT l_orderkey, p[1] AS part_1, p[2] AS part_2, p[3] AS part_3, p[4] AS part_4, p[5] AS part_5 FROM (
  SELECT l_orderkey, list_sort(list(l_partkey)) AS p FROM lineitem GROUP BY l_orderkey)
""")
def array_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five parts of each order as columns, null where there are fewer."""
    parts = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("p"))
    return parts.select("l_orderkey", *nested.padded(F.col("p"), "part_"))


@query("""
SELECT o_orderkey, CAST(try_strptime(CASE WHEN o_orderkey % 7 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%m/%d/%Y') END, '%m/%d/%Y') AS DATE) AS game_date FROM orders
""")
def lenient_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates from text, null where there is none."""
    shown = F.when(F.col("o_orderkey") % 7 == 0, F.lit("soon")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.lenient_date(shown).alias("game_date"))


@query("""
SELECT label, href, count(*) AS n_games FROM (
  SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1)) AS href,
         unnest(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 2)) AS label FROM pages) GROUP BY ALL
""")
def count_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many pages each anchor occurs, however often it does in one."""
    pattern = F.lit('<a href="/([^"]*)">([^<]*)</a>')
    pairs = F.arrays_zip(F.regexp_extract_all("html", pattern, F.lit(1)).alias("href"), F.regexp_extract_all("html", pattern, F.lit(2)).alias("label"))
    found = table(spark, sf_dir, "pages").select("page_id", F.explode(pairs).alias("_a")).select("page_id", "_a.label", "_a.href").distinct()
    return found.groupBy("label", "href").agg(F.count(F.lit(1)).alias("n_games"))


@query(r"""
SELECT doc_id, coalesce(contains(text, 'ing'), false) AS is_fastbreak_like, nullif(regexp_extract(text, 'of (\w+)', 1), '') AS turnover_like,
       CAST(nullif(regexp_extract(text, '\(([0-9])', 1), '') AS BIGINT) AS number_like FROM documents
""")
def event_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flags and extracts in the manner of the event grammar, on prose."""
    return table(spark, sf_dir, "documents").select("doc_id", text.has("text", "ing").alias("is_fastbreak_like"), text.extract("text", r"of (\w+)").alias("turnover_like"), text.extract("text", r"\(([0-9])", "bigint").alias("number_like"))


@query("""
SELECT l_returnflag, l_linestatus, l_shipdate, l_orderkey, l_linenumber FROM lineitem WHERE l_shipdate IS NOT NULL AND l_returnflag IS NOT NULL AND l_discount IS NOT NULL
""")
def null_row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a null among some columns."""
    return table(spark, sf_dir, "lineitem").dropna(how="any", subset=["l_shipdate", "l_returnflag", "l_discount"]).select("l_returnflag", "l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber")


@query("""
SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL
""")
def windowed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly counts of events by type, by the plan that also runs on a stream."""
    return arrivals.windowed_counts(table(spark, sf_dir, "events"))


@query("""
SELECT o_orderkey AS contest_id, o_orderdate AS game_date, CAST(CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS BIGINT) AS season,
       printf('%d-%s', CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) ELSE year(o_orderdate) - 1 END,
              right(CAST(CASE WHEN month(o_orderdate) >= 7 THEN year(o_orderdate) + 1 ELSE year(o_orderdate) END AS VARCHAR), 2)) AS label
FROM orders
""")
def season_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by season of two years, with its label."""
    season = (F.year("o_orderdate") + (F.month("o_orderdate") >= 7).cast("int")).cast("long")
    label = F.format_string("%d-%s", F.col("season") - 1, F.right(F.col("season").cast("string"), F.lit(2)))
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("contest_id"), F.col("o_orderdate").alias("game_date"), season.alias("season")).withColumn("label", label)
