"""The registered queries of the llm operators over the test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import ann, language_model, oracle, piece_encoding, prefix_trie, quality, toxicity, whitening
from strata.llm._labelled import fold
from strata.llm.decontaminate import contamination
from strata.llm.mixing import mix
from strata.llm.near_dup import NearDupParams, near_duplicates
from strata.llm.pii import digest, find_pii
from strata.llm.revisits import captures_of_pages, resolve_revisits
from strata.llm.token_counts import token_counts


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (``TOKENIZER_DIR`` overrides the package)."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_nn_descent_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 nearest of every 20th vector, found by greedy search on the NN-descent graph."""
    index = ann.build_index(_table(spark, sf, "embeddings"))
    return ann.search(index, index.vectors.filter("id % 20 = 0"), k=20)


def op2_sainte_lague_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Words that each document gives to a mix of 150 % of all words."""
    return mix(_table(spark, sf, "documents"))


def op3_pii_disclosure(spark: SparkSession, sf: str) -> DataFrame:
    """Personal data and the terms that give it away, per document."""
    return digest(find_pii(_table(spark, sf, "documents")))


def op4_positional_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark windows of 10 words found in documents through the positional index."""
    found = contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"), width=10)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op5_minhash_near_dup(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of documents whose 4-word shingle sets are 80 % alike."""
    return near_duplicates(_table(spark, sf, "documents"), NearDupParams(k=4)).drop("text_key")


def _scored(scores: DataFrame, parts: int, value: int) -> DataFrame:
    return scores.select("doc_id", F.coalesce(fold("doc_id", parts) == value, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         *[c for c in scores.columns if c not in ("doc_id", "score")])


def op6_bradley_terry_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document from preference pairs of the rows outside fold 2 of 4."""
    docs = _table(spark, sf, "documents")
    model = quality.fit(docs, _table(spark, sf, "labels"), allowed=lambda c: fold(c, 4) != 2)
    return _scored(quality.score_texts(docs, model), 4, 2)


def op7_gru_language_model(spark: SparkSession, sf: str) -> DataFrame:
    """Log-likelihood of every document, learnt from the rows outside fold 2 of 7."""
    docs = _table(spark, sf, "documents")
    out = language_model.log_likelihood(docs, fold("doc_id", 7) != 2)
    return out.select("doc_id", language_model.in_fold("doc_id", 7, 2).alias("held_out"),
                      *[c for c in out.columns if c != "doc_id"])


def op8_cnn_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document, learnt from the rows outside fold 1 of 3; ``flagged``
    is the decision at the language's calibrated threshold."""
    docs = _table(spark, sf, "documents")
    net = toxicity.fit(docs, _table(spark, sf, "labels"), allowed=lambda c: fold(c, 3) != 1)
    scores = toxicity.score_texts(docs, net, keep=("doc_id", "lang"))
    cut = toxicity.threshold_of(net, F.col("lang"))
    return _scored(scores.withColumn("threshold", cut).withColumn("flagged", F.col("score") >= cut).drop("lang"), 3, 1)


def op9_revisit_resolution(spark: SparkSession, sf: str) -> DataFrame:
    """Revisits of page sections resolved to the latest earlier response; headers as text."""
    out = resolve_revisits(captures_of_pages(_table(spark, sf, "pages")))
    line = F.transform("headers", lambda h: F.concat(h["name"], F.lit("="), F.coalesce(h["value"], F.lit(""))))
    return out.withColumn("headers", F.when(F.col("headers").isNotNull(), F.array_join(F.array_sort(line), ";")))


def op10_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Token counts of all documents under word_bpe_49k.json."""
    return token_counts(_table(spark, sf, "documents"), tokenizer_path("word_bpe_49k.json"))


def op11_whitened_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Every embedding on the 8 leading principal components, scaled to unit variance."""
    return whitening.whitened(_table(spark, sf, "embeddings"))


def op12_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct beginning of the conversations, rebuilt on shared heads, with its totals."""
    turns = prefix_trie.turn_sequences(_table(spark, sf, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns))


def op13_piece_encoding(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of all documents under piece_bpe_32k.model and what they decode to, as digests."""
    return piece_encoding.digest(piece_encoding.encode_texts(_table(spark, sf, "documents"), tokenizer_path("piece_bpe_32k.model")))


QUERIES = {f.__name__: f for f in (
    op1_nn_descent_search, op2_sainte_lague_mix, op3_pii_disclosure, op4_positional_decontamination, op5_minhash_near_dup,
    op6_bradley_terry_quality, op7_gru_language_model, op8_cnn_toxicity, op9_revisit_resolution,
    op10_token_counts, op11_whitened_embeddings, op12_conversation_trie, op13_piece_encoding)}
SQL: dict[str, str] = dict(oracle.SQL)
