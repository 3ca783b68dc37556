"""Rows shared by the llm tests: the odd cases every operator must survive."""

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"
DOC = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                  StructField("lang", StringType()), StructField("source", StringType()),
                  StructField("n_chars", LongType())])
LABEL = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()),
                    StructField("toxic", IntegerType())])
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew some odd green tea today".split()


def docs(spark, rows):
    """``rows``: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOC)


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long_text = " ".join(WORDS[i % 17] + str(i % 977) for i in range(60_000))
    base = " ".join(WORDS)
    return [(1, base, "s"), (1, base, "s"), (2, base, None), (3, None, "s"), (4, "", "s"), (None, base, "s"), (None, None, None),
            (5, long_text, "t"), (6, " \t\n ", "t"), (7, "Word", ""), (7, "other words here", "t"), (8, "\x00 é 中 😀", "ß")]


def clashing(df):
    """Extra columns named like results and internals of the operators."""
    for c in ("score", "kept", "size", "taken", "id", "t", "n", "text_key", "sig", "segment", "spans", "target", "_id", "_key"):
        df = df.withColumn(c, F.lit("x"))
    return df
