"""Small hand-made documents: nulls, empty and long texts, ties, repeated rows and clashing columns."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 97} filler{i % 13}" for i in range(20_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog by the river", "en", "a", 10),
    (2, "", "en", "a", 0),
    (3, None, None, None, None),
    (None, "a text without an id", "en", "b", None),
    (4, LONG, "en", "b", None),
    (5, "The quick brown fox jumps over the lazy dog by the river", "en", "b", 10),
    (5, "The quick brown fox jumps over the lazy dog by the river", "en", "b", 10),
    (6, " \t\n ", "en", None, 4),
    (7, "don't <|endoftext|> Übermaß été <|startoftext|>x ½ ΑΣ 日本 tab\tnew\nline", "de", "c", 1),
]


def make(spark, rows=ROWS, extra=True):
    """The rows as a table; with ``extra``, columns whose names operators might use for themselves."""
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        for name in ("size", "shard", "slot", "score", "kept", "component_id", "sequence_id", "n_words", "_cell", "_rank"):
            df = df.withColumn(name, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
