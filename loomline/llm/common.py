"""What several of the operators share: word patterns, checkpoints, row numbers."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space between words, as a Java character class, and the same characters one by one.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset and the master is a local one, as in tests, a temporary folder is set
    as the checkpoint folder. On a cluster, an unset folder is an error.
    """
    set_already = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir() or ""
    if not set_already:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        set_already = f"file://{tempfile.mkdtemp(prefix='loomline-')}"
        spark.sparkContext.setCheckpointDir(set_already)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(set_already)
    return set_already.rstrip("/")


def own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/loomline-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for written intermediate files, in this application's part of the shared folder."""
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate files, once the results that read them are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(own_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """A setting of the session for the jobs run inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut(df: DataFrame) -> DataFrame:
    """The same rows from reliable checkpoint files, with their lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table written in the shared folder, whose size the planner knows."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def word_count(text: str | Column) -> Column:
    """Number of words of a text as a long; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def number_rows(df: DataFrame, order: list, name: str) -> DataFrame:
    """Give each row its 0-based rank in a global order, as the long column ``name``.

    Rows are range-partitioned and sorted, and written as a checkpoint so that a lost
    executor cannot renumber them; one count per partition is all that meets in one task.
    Rows equal in ``order`` are numbered in an order that the checkpoint fixes.
    """
    base, row, part = f"_{name}_base", f"_{name}_row", f"_{name}_part"
    # Range bounds come from a sample of the rows, which must not run what made them twice.
    sorted_rows = cut(cut(df).repartitionByRange(*order).sortWithinPartitions(*order).withColumn(row, F.monotonically_increasing_id()))
    placed = sorted_rows.withColumn(part, F.shiftright(row, 33))
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias(base))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(part, F.coalesce(F.sum(base).over(before), F.lit(0)).alias(base))
    within = F.col(row).bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition of the job, so this side stays tiny whatever the data.
    joined = placed.join(F.broadcast(bases), part)
    return joined.withColumn(name, F.col(base) + within).drop(base, row, part)
