"""How far sources of a language part from each other and from their language, in words.

Each language keeps the terms that stand in enough of its documents. Every source, and each
language as a whole, gives each kept term a smoothed share, an integer in billionths. A
source's most over-used terms are found by radix selection on the difference of its share
to its language's; sources are compared by the sum of differences over all kept terms.

Shares of terms that a source lacks are all the same, its baseline. So the sum for a pair
of sources is that of the two baselines over all terms, corrected where a source has a term
(by the other's baseline: one row for each distinct share and other source) and corrected
again where both have it (one row a term and pair, added up before it is shuffled). Absent
terms cost nothing.

All arithmetic is on integers; shares are divided as decimals of 38 digits.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import stored
from loomline.llm.selection import largest

#: Terms are runs of A-Z, a-z and what is not ASCII; every other byte below 128 parts them, and A-Z become a-z.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
#: Entries that a task counts before it hands them on.
HELD = 500_000
#: The scale of a share, and what is added to every count.
SCALE, ADDED = 1_000_000_000, 5
#: Differences of shares are at most SCALE + 1.
VALUE_BITS = 31


def share(count: str, total: str, kept: str) -> Column:
    """The smoothed share of a count, in units of 1 / SCALE, plus one."""
    return F.expr(f"1 + (cast({count} as decimal(28, 0)) + {ADDED}) * {SCALE} div (cast({total} as decimal(28, 0)) + {ADDED} * {kept})")


def partial_counts(texts: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, counted where texts are read, in tables of about HELD entries."""
    names = ["lang", "source", "term", "n", "docs"]

    def handed_on(groups):
        for (lang, source), (counts, docs) in groups.items():
            # Both saw a document's new terms in one go, but not in the same order.
            terms = list(counts)
            same = [pa.array([x], pa.string()).take(pa.array(np.zeros(len(terms), np.int32))) for x in (lang, source)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64(), size=len(terms)), pa.array(map(docs.__getitem__, terms), pa.int64(), size=len(terms))], names)

    def scan(batches):
        groups, held = {}, 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = text.translate(TABLE).split()
                if not words:
                    continue
                counts, docs = groups.get((lang, source)) or groups.setdefault((lang, source), (Counter(), Counter()))
                held -= len(counts)
                counts.update(words)
                docs.update(set(words))
                held += len(counts)
                if held > HELD:
                    yield from handed_on(groups)
                    groups, held = {}, 0
        yield from handed_on(groups)

    return texts.mapInArrow(scan, "lang string, source string, term string, n long, docs long")


def kept_counts(texts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n): occurrences of each kept term in each source that has it, and in the language."""
    counts = partial_counts(texts).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A term has a row for each source of the language at most.
    over = Window.partitionBy("lang", "term")
    whole = counts.withColumns({"lang_n": F.sum("n").over(over), "lang_docs": F.sum("docs").over(over)})
    return whole.where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "n", "lang_n")


def group_totals(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, kept, total, lang_total, base) of every group that occurs: kept terms of the language, occurrences, and the share of an absent term."""
    langs = counts.groupBy("lang", "term").agg(F.first("lang_n").alias("n")).groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["kept", "total", "lang_total"])
    return groups.withColumn("base", F.when(F.col("kept") > 0, share("0", "total", "kept")).otherwise(0).cast("long"))


def pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum of differences of shares for each two sources of a language, both ways."""
    own = groups.select("lang", "source", "base", "kept")
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"))
    gap = F.abs(F.col("base") - F.col("item_base"))
    bases = own.join(other, "lang").where("source < item").select("lang", "source", "item", (F.col("kept") * gap).alias("value"))
    distinct = shares.groupBy("lang", "source", "base", "p").agg(F.count(F.lit(1)).alias("n")).join(other, "lang").where("source <> item")
    alone = distinct.select("lang", F.least("source", "item").alias("source"), F.greatest("source", "item").alias("item"), (F.col("n") * (F.abs(F.col("p") - F.col("item_base")) - gap)).alias("value"))
    here = shares.select("lang", "term", "source", "p", "base")
    there = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("item_p"), F.col("base").alias("item_base"))
    correction = F.abs(F.col("p") - F.col("item_p")) - F.abs(F.col("p") - F.col("item_base")) - F.abs(F.col("item_p") - F.col("base")) + gap
    both = here.join(there, ["lang", "term"]).where("source < item").select("lang", "source", "item", correction.alias("value"))
    # Each part is added up by itself first, so that what is shuffled is a row for each pair and task at most.
    parts = [part.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")) for part in (bases, alone, both)]
    sums = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item"))))
    return sums.select("lang", ends.alias("e"), "value").select("lang", "e.source", "e.item", "value")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group of the documents.

    Part ``pair``: every other source of the language, and the sum of differences over all
    kept terms (0 if none is kept). Part ``term``: the group's ``top`` most over-used terms.
    Ranks are from 1 by descending value, then by the item's UTF-8 bytes.

    Null text, lang and source are read as empty ones. A repeated row counts again. A
    document without terms makes its group occur and no more; a group without over-used terms has
    no rows of part ``term``, one without other sources none of part ``pair``. An empty table
    gives no rows. Other columns are not read, whatever their names.
    """
    blank = F.lit("")
    texts = docs.select(F.coalesce("lang", blank).alias("lang"), F.coalesce("source", blank).alias("source"), F.coalesce("text", blank).alias("text"))
    counts = stored(kept_counts(texts, least_docs), "kept-counts")
    groups = stored(group_totals(texts, counts), "groups")
    shares = stored(counts.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total", "kept"), "q": share("lang_n", "lang_total", "kept")}).select("lang", "source", "term", "p", "q", "base"), "shares")
    over_used = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = largest(over_used, ["lang", "source"], "value", "item", VALUE_BITS, top)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pair_sums(shares, groups), "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
