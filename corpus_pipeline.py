"""A training corpus from raw documents: five stages over whole tables.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of documents. The tables an operator works with are removed once the stage's decisions (keys,
numbers, places) are written, so only these stand beside the texts.

1. toxicity: documents whose score reaches their language's calibrated threshold go;
2. near_duplicates: one document of each group of near copies (five-word shingles,
   similarity 0.8) stays;
3. decontamination: documents that hold a window of ten benchmark words go;
4. pii: personal data, and words that give it away, are replaced in the texts;
5. mixing: sources are mixed to target weights; documents that the mix takes nothing of go,
   the others say how many of their words are taken.

Rules for odd input, all stages: null and empty texts stay unless the mix takes nothing of
them (it never does: they have no words); empty tables pass through; further columns of
documents are carried along, and a column named like a result of the last stage is
replaced by it. Repeated rows are near copies of each other: one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import toxicity as toxic
from strata.llm._tables import passing_tables, written
from strata.llm.decontaminate import contamination
from strata.llm.mixing import MixParams, mix
from strata.llm.near_dup import NearDupParams, near_duplicates
from strata.llm.pii import sanitised
from strata.session import scratch_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the text classifier calls toxic."""
    net = toxic.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    renamed = docs.withColumnsRenamed({c: f"_{i}" for i, c in enumerate(docs.columns)})
    at = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    scored = toxic.score_texts(renamed, net, text_col=at["text"], keep=tuple(at.values()))
    kept = scored.filter(F.col("score") < toxic.threshold_of(net, F.col(at["lang"])))
    return kept.select(*[F.col(v).alias(k) for k, v in at.items()])


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group; rows that repeat an id and text are one document."""
    with passing_tables(spark):
        found = near_duplicates(docs, NearDupParams(k=5)).filter(~F.col("kept"))
        gone = written(found.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "dedup", outlives=True)
    kept = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_key"]), "left_anti")
    # Few ids repeat, as a rule none: written, their size is known and the texts stay put.
    again = written(docs.groupBy(F.col("doc_id").alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
                        .filter("_n > 1").select("_id"), "dedup")
    same = kept["doc_id"].eqNullSafe(again["_id"])
    once = kept.join(again, same, "left_anti")
    twice = kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(twice)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of ten consecutive words of a benchmark item."""
    key = F.xxhash64("doc_id", "text")  # rows of one id with different texts are judged apart
    with passing_tables(spark):
        found = contamination(docs.select(key.alias("_key"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                              width=10, id_col="_key")
        gone = written(found.filter(F.col("n_hit") > 0).select(F.col("doc_id").alias("_gone")).distinct(), "contaminated", outlives=True)
    return docs.join(gone, key == gone["_gone"], "left_anti")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and the words that give it away; lengths follow the texts."""
    clean = sanitised(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that each document gives to the mix; documents it takes nothing of go.

    Only ids and sizes are mixed; the texts are joined once at the end. Rows that repeat an
    id, source and text take the same number of words, the smallest of theirs.
    """
    key = F.xxhash64("doc_id", "source", "text")
    with passing_tables(spark):
        narrow = mix(docs.select(key.alias("_key"), "source", "text"), MixParams(), keep=("_key",), order_col="_key")
        taken = written(narrow.filter(F.col("taken") > 0).groupBy("_key").agg(
            *[F.min(c).alias(c) for c in ("size", "source_size", "target", "taken")]), "mixed", outlives=True)
    out = ["size", "source_size", "target", "taken"]
    return docs.join(taken, key == taken["_key"]).select(
        *[docs[c] for c in docs.columns if c not in out], *[taken[c] for c in out])


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates_stage),
          ("decontamination", decontamination), ("pii", pii), ("mixing", mixing)]

#: Stages rest on a trained classifier and seeded choices: tested by brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{scratch_dir(spark, 'pipeline')}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
