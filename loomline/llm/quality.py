"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed words and word pairs: of trusted
documents, and of the raw corpus. A document's score is the mean over its n-grams, so it
does not depend on length; documents below a fixed threshold go. Everything is DataFrame
operations on whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import SPACE, SPACE_CHARS, cut

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED_PERCENT = 8, 20, 30
#: The method's parameters: hash buckets, the least score kept, and how many trusted documents the target is fitted on.
BUCKETS, THRESHOLD, TRUSTED_DOCS = 10_000, -0.07, 20_000


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text, an empty array for null."""
    inner = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(inner != "", F.split(inner, SPACE)).otherwise(F.expr("cast(array() as array<string>)"))


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def repeated_words(hashes: Column) -> Column:
    """How many words lie in a window of WINDOW words that the text has twice or more, the first included.

    ``hashes`` are those of the text's words; windows are compared by 64-bit hashes of theirs. Texts without a repeat, most of them, stop after
    one distinct count; for the others, windows sorted by hash show their repeats side by
    side, and sorted positions give the words they cover.
    """
    n = F.size(hashes)
    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))

    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def positions(pairs: Column) -> Column:
        same = F.filter(pairs, lambda x, j: F.coalesce(F.get(pairs, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(pairs, j + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        some = bound(bound(pairs, positions), covered)
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), some).otherwise(F.lit(0))

    return F.when(n >= WINDOW, bound(windows, count)).otherwise(F.lit(0))


def base_counts(text: Column, hashes: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all long, 0 for null."""
    solid = without(text, SPACE_CHARS)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(without(x, SPACE_CHARS)) > 0)
    dup_lines = bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    made = {
        "n_words": F.size(hashes),
        "word_chars": F.length(solid),
        "n_symbols": F.length(text) - F.length(without(text, SYMBOLS)),
        "n_dup_lines": F.when(text.isNotNull(), dup_lines),
        "n_repeat_words": repeated_words(hashes),
    }
    return {name: F.coalesce(c, F.lit(0)).cast("long") for name, c in made.items()}


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def gram_buckets(words: Column, hashes: Column) -> Column:
    """Hash buckets of the words, whose hashes are given, and of the pairs of neighbours."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    ones = F.transform(hashes, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    twos = F.zip_with(F.slice(words, F.lit(1), n), F.slice(words, F.lit(2), n), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
    return F.concat(ones, twos)


def fit_ratio(docs: DataFrame, labels: DataFrame, trusted_docs: int = TRUSTED_DOCS) -> list[float]:
    """The log-likelihood ratio of each of the BUCKETS buckets.

    Raw counts cover all documents. The target's are those of up to ``trusted_docs``
    documents labelled of quality 1, those with the least hash of doc_id. Counts are
    smoothed by one. Buckets without counts have the ratio of their smoothing.
    """
    trusted = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    trusted = trusted.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_docs).withColumn("_trusted", F.lit(True))
    # Trusted ids number trusted_docs at most.
    grams = docs.select("doc_id", "text").join(F.broadcast(trusted), "doc_id", "left").select("_trusted", F.explode(bound(words_of(F.col("text")), lambda words: gram_buckets(words, word_hashes(words)))).alias("b"))
    counts = grams.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("target"))
    table = cut(counts)
    sums = table.agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).first()
    raw_all, target_all = (sums["raw"] or 0) + BUCKETS, (sums["target"] or 0) + BUCKETS
    ratio = [math.log(1 / target_all) - math.log(1 / raw_all)] * BUCKETS
    for r in table.collect():  # BUCKETS rows at most
        ratio[r["b"]] = math.log((r["target"] + 1) / target_all) - math.log((r["raw"] + 1) / raw_all)
    return ratio


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, trusted_docs: int = TRUSTED_DOCS) -> DataFrame:
    """The documents with base counts, ``base_failed``, ``quality_score`` and ``kept``.

    A null or empty text has counts of 0 and a score of 0; it fails the base rules, as do
    texts of under 20 words and those with over 30 % of their words in repeated windows.
    Repeated rows are judged alike. Without labels the ratio is that of the smoothing and the
    threshold decides little. Input columns named as the added ones are replaced.
    """
    # A constant of BUCKETS numbers; the optimizer folds the split and the cast once.
    ratio = F.split(F.lit(",".join(map(repr, fit_ratio(docs, labels, trusted_docs)))), ",").cast("array<double>")

    def score(buckets: Column) -> Column:
        total = F.aggregate(buckets, F.lit(0.0), lambda a, b: a + F.get(ratio, b))
        return F.when(F.size(buckets) > 0, total / F.size(buckets)).otherwise(F.lit(0.0))

    out = counted(docs, {"quality_score": lambda words, hashes: bound(gram_buckets(words, hashes), score)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= threshold))


def counted(docs: DataFrame, more: dict[str, Callable[[Column, Column], Column]] | None = None) -> DataFrame:
    """The documents with base counts and ``base_failed``, and with what else is made of their words and these words' hashes."""
    text, more = F.col("text"), more or {}

    def all_of(words: Column) -> Column:
        return bound(word_hashes(words), lambda hashes: parts(words, hashes))

    def parts(words: Column, hashes: Column) -> Column:
        made = base_counts(text, hashes) | {name: make(words, hashes) for name, make in more.items()}
        return F.struct(*[c.alias(name) for name, c in made.items()])

    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *more]
    out = docs.withColumn("_q", bound(words_of(text), all_of)).withColumns({n: F.col(f"_q.{n}") for n in names}).drop("_q")
    return out.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT))
