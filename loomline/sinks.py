"""Writers: seasons committed with their manifest row, csv.gz made in parallel, and the master trio."""

from __future__ import annotations

import csv
import gzip
import io
import json
import logging
import shutil
import subprocess
import threading
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomline import schemas
from loomline.operators.relational import upsert
from loomline.registry import Dataset
from loomline.sources.games import read_manifest
from loomline.storage import local, store_for

log = logging.getLogger("loomline")
#: Rows of a part of a csv.gz, about; parts at most; and rows of the sample that cuts them, at most twice.
PART_ROWS, MOST_PARTS, SAMPLE_ROWS = 200_000, 256, 4096
#: Manifests are read, renewed and replaced by one thread of a process at a time.
MANIFESTS = threading.Lock()


def now_text() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S UTC")


def dataset_root(dataset: Dataset, base: str, league: str) -> str:
    return f"{base}/{league}/{dataset.name}"


def commit_season(df: DataFrame, dataset: Dataset, season: int, base: str, league: str) -> int:
    """Replace a season's partition and its row of the manifest, both or neither; returns the rows written.

    Tasks write to a staging folder, by Spark's own task commits, and count their rows on
    the way. A failure until then leaves the old season and manifest as they are. A journal
    file is the commit: what it lists is moved in place at once, or, if the driver
    dies meanwhile, by the next call for this season, whatever that call then does. A table without rows
    commits nothing. Seasons of one dataset may be committed by several threads of a process,
    not by several processes.
    """
    root, spark = dataset_root(dataset, base, league), df.sparkSession
    recover(spark, root, season)
    stage, counted = f"{root}/_staging/{season}-{uuid.uuid4().hex}", Observation()
    store = store_for(base, spark)
    try:
        df.drop("season").observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{stage}/season={season}")
        rows = counted.get["rows"]
    except BaseException:
        drop_stage(store, root, stage)
        raise
    if not rows:
        drop_stage(store, root, stage)
        return 0
    entry = {"dataset": dataset.name, "season": season, "row_count": rows, "generated_at_utc": now_text()}
    store.write(f"{stage}/journal.new", json.dumps(entry))
    store.move(f"{stage}/journal.new", f"{stage}/journal")
    roll_forward(spark, root, stage)
    return rows


def recover(spark: SparkSession, root: str, season: int) -> None:
    """End what an earlier run began for a season: moved in place if its journal is there, else deleted."""
    store = store_for(root, spark)
    for name in store.names(f"{root}/_staging"):
        if name.startswith(f"{season}-"):
            stage = f"{root}/_staging/{name}"
            if store.exists(f"{stage}/journal"):
                log.warning("%s: season %s was committed but not in place; done now", root, season)
                roll_forward(spark, root, stage)
            else:
                drop_stage(store, root, stage)


def drop_stage(store, root: str, stage: str) -> None:
    """Delete a staging folder, and the folders around it that it leaves empty."""
    store.delete(stage)
    store.prune(f"{root}/_staging")
    store.prune(root)


def roll_forward(spark: SparkSession, root: str, stage: str) -> None:
    """Put a staged season and its manifest row in place; every step may be repeated."""
    store = store_for(root, spark)
    entry = json.loads(store.read(f"{stage}/journal"))
    new, live = f"{stage}/season={entry['season']}", f"{root}/parquet/season={entry['season']}"
    if store.exists(new):
        if store.exists(live):
            store.move(live, f"{stage}/replaced")
        store.move(new, live)
    with MANIFESTS:
        upsert_manifest(spark, root, entry)
    drop_stage(store, root, stage)


def upsert_manifest(spark: SparkSession, root: str, entry: dict) -> str:
    """Renew the (dataset, season) row of a manifest, sorted by season, by replacing the file."""
    path, store = f"{root}/manifest.csv", store_for(root, spark)
    new = spark.createDataFrame([tuple(entry[n] for n in schemas.names(schemas.MANIFEST))], schemas.MANIFEST)
    rows = upsert(read_manifest(spark, path), new, ["dataset", "season"]).orderBy("season").collect()
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([schemas.names(schemas.MANIFEST), *map(tuple, rows)])
    fresh = f"{root}/_manifest-{uuid.uuid4().hex}"
    store.write(fresh, out.getvalue())
    store.replace(fresh, path)
    return path


def part_of(df: DataFrame, order: list[str]) -> tuple[Column, int]:
    """(the part that a row falls in, number of parts) of a table cut into parts of about PART_ROWS rows that follow each other in order.

    The cuts come from a sample by hash of the order's values, so the same rows always give
    the same parts, whatever tasks they are in. Rows that tie stay in one part.
    """
    rows = df.count()
    parts = min(MOST_PARTS, -(-rows // PART_ROWS))
    sample = df.select(*order).where(F.pmod(F.xxhash64(*order), F.lit(max(1, rows // SAMPLE_ROWS))) == 0).distinct().orderBy(*order).limit(2 * SAMPLE_ROWS)
    found = sample.collect() if parts > 1 else []
    cuts = [found[i * len(found) // parts] for i in range(1, parts)] if len(found) >= parts else found
    if not cuts:
        return F.lit(0), 1
    kinds = dict(df.dtypes)
    listed = F.array(*[F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(order, cut, strict=True)]) for cut in cuts])
    return F.size(F.filter(listed, lambda c: c <= F.struct(*order))), len(cuts) + 1


def write_csv_gz(df: DataFrame, target: str, order: list[str]) -> str:
    """One gzipped csv with a header, the same bytes for the same rows; nested columns are refused.

    Values keep their white space, quotes in them are doubled, an empty text is a pair of
    quotes and null is nothing. Rows are ordered by the columns asked for and then by all others. Parts are sorted,
    formatted and compressed by executors, each to a gzip member of its own; the driver puts
    the members one after the other, which is a gzip file, on the file system of the target.
    """
    nested = [n for n, k in df.dtypes if k.startswith(("array", "struct", "map", "variant"))]
    if nested:
        raise ValueError(f"csv cannot hold nested columns: {', '.join(nested)}")
    spark, parts = df.sparkSession, f"{target}.parts"
    store = store_for(target, spark)
    order = order or df.columns
    part, n = part_of(df, order)
    dealt = df.withColumn("_part", part).repartitionById(n, F.col("_part"))
    sorted_parts = dealt.sortWithinPartitions(*order, *[c for c in df.columns if c not in order]).drop("_part")
    sorted_parts.write.mode("overwrite").option("header", False).option("emptyValue", '""').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(parts)
    head = io.StringIO()
    csv.writer(head, lineterminator="\n").writerow(df.columns)
    members = [f"{parts}/{name}" for name in store.names(parts) if name.startswith("part-")]
    store.join(gzip.compress(head.getvalue().encode(), 6, mtime=0), members, target)
    store.delete(parts)
    return target


def write_masters(full: DataFrame, present: DataFrame, coverage: DataFrame, base: str, league: str) -> list[str]:
    """The three coverage tables, from one cached index; an empty index is an error."""
    if full.isEmpty():
        raise ValueError("the coverage index is empty")
    paths = []
    for name, df in (("schedule_master", full), ("games_in_data_repo", present), ("schedule_coverage", coverage)):
        paths.append(f"{base}/{league}/{league}_{name}.parquet")
        df.coalesce(1).write.mode("overwrite").parquet(paths[-1])
    return paths


def to_rds(parquet: str, rds: str, rscript: str | None = None) -> None:
    """Convert a parquet path by an R installation with arrow, if there is one."""
    program = rscript or shutil.which("Rscript")
    if not program:
        raise RuntimeError("no Rscript found")
    code = f"saveRDS(as.data.frame(arrow::open_dataset('{local(parquet)}')), '{local(rds)}')"
    done = subprocess.run([program, "-e", code], capture_output=True, text=True, check=False)
    if done.returncode:
        raise RuntimeError(f"Rscript failed: {done.stderr.strip()[-300:]}")
