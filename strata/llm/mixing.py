"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Sizes are words. Each source's target comes from the weights: shares of the total in
   proportion to weight, capped at ``max_repeat`` times the source's size, the excess
   shared again among the others until none is above its cap.
2. The mix is a number of equal blocks of ``block`` words. Blocks are given to sources by
   highest quotients target / (2 * seats + 1), then within a source to its shards (groups
   of documents of bounded size, so a hot source is many shards) by the same rule. All
   quotas are integers and add up exactly.
3. Within a shard the documents, in seeded order, form one word sequence cut into blocks.
   Whole passes over all blocks come first, the rest are blocks picked by a seeded
   permutation. A document's share is the overlap of its words with the picked blocks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm._tables import written
from strata.operators.keys import dense_ids


@dataclass(frozen=True)
class MixParams:
    """Weights repeat over the sources in code point order (null last); ``total`` is the
    mix's size as a multiple of all words. A shard holds about ``shard_words`` words and
    ``shard_docs`` documents. A small block keeps small sources near their targets."""

    weights: tuple[float, ...] = (5, 2, 1)
    total: float = 1.5
    max_repeat: int = 2
    block: int = 8
    shard_words: int = 1 << 22
    shard_docs: int = 1 << 14
    seed: int = 7


def source_targets(sources: DataFrame, p: MixParams) -> DataFrame:
    """``(source, source_size, docs)`` -> the same with ``target`` and the rank ``_order``.

    The water level is found by rounds of one small aggregate each: sources that the
    current level lifts above their cap are fixed there and leave the sharing.
    """
    cols = sources.columns
    ranked = dense_ids(sources, ["source"], out="_rank", start=0)
    weights = F.array(*[F.lit(float(w)) for w in p.weights])
    ranked = written(ranked.withColumn("w", weights[(F.col("_rank") % len(p.weights)).cast("int")])
                           .withColumn("cap", F.col("source_size").cast("double") * p.max_repeat), "mix-sources")
    whole = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * p.total
    level, capped = None, -1
    while True:
        above = F.lit(False) if level is None else F.col("w") * level > F.col("cap")
        r = ranked.agg(F.sum(F.when(above, F.col("cap")).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("w"))),
                       F.count(F.when(above, 1))).first()
        if r[2] == capped or not r[1]:
            break
        capped, level = r[2], max(0.0, whole - r[0]) / r[1]
    share = F.col("cap") if level is None else F.least(F.col("cap"), F.col("w") * level)
    return ranked.select(*cols, share.alias("target"), F.col("_rank").alias("_order"))


def apportion(df: DataFrame, group: list[str], weight: str, seats: str) -> DataFrame:
    """Add ``quota``: ``seats`` (one value per group) dealt by highest quotients
    weight / (2 * k + 1); ties go to the smaller ``_order``.

    Rounding weight / (group weight / seats) gives all but a few seats; the rest are the
    next quotients (or the last ones taken back), and of those only as many are listed
    as a member can get.
    """
    g = df.groupBy(*group).agg(F.sum(weight).alias("_t"), F.count(F.lit(1)).alias("_m"))
    both = df.join(g, group)
    ideal = F.when(F.col("_t") > 0, F.col(weight) / F.col("_t") * F.col(seats)).otherwise(0.0)
    both = both.withColumn("_q", F.floor(ideal + 0.5))
    total = both.groupBy(*group).agg(F.sum("_q").alias("_sum"))
    both = both.join(total, group).withColumn("_d", F.col(seats) - F.col("_sum"))
    most = F.ceil((F.abs("_d") + F.col("_m")) * F.col(weight) / F.col("_t")) + 1
    step = F.when(F.col("_d") > 0, F.sequence(F.lit(0).cast("long"), most.cast("long"))).otherwise(
        F.sequence(F.lit(-1).cast("long"), -F.least(most, F.col("_q")).cast("long") - 1))
    cand = (both.filter((F.col("_d") != 0) & (F.col("_t") > 0) & (F.col(weight) > 0))
                .withColumn("_k", F.explode(step)).filter(F.col("_q") + F.col("_k") >= 0)
                .withColumn("_quot", F.col(weight) / (2 * (F.col("_q") + F.col("_k")) + 1)))
    sign = F.signum("_d")
    w = Window.partitionBy(*group).orderBy((-sign * F.col("_quot")).asc(), (sign * F.col("_order")).asc(),
                                            (sign * F.col("_k")).asc())
    extra = (cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= F.abs("_d"))
                 .groupBy(*group, "_order").agg(F.sum(sign).cast("long").alias("_x")))
    keep = [*df.columns, (F.col("_q") + F.coalesce("_x", F.lit(0))).cast("long").alias("quota")]
    return both.join(extra, [*group, "_order"], "left").select(*keep)


def word_count(text) -> F.Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(docs: DataFrame, p: MixParams = MixParams(), source_col: str = "source", text_col: str = "text",
        keep: tuple[str, ...] = ("doc_id",), order_col: str = "doc_id") -> DataFrame:
    """Every row with ``keep`` columns and ``size, source_size, target, taken``.

    ``taken`` is the number of the document's words in the mix, repeats counted; it never
    exceeds ``max_repeat`` times its size. Null texts and texts without words have size 0
    and take 0; a null source is a source of its own, last in order. Rows are spread over
    shards and ordered by a seeded hash of ``order_col``, then size: identical rows are
    interchangeable and reruns agree. An empty table gives no rows. Input columns named
    like a result column are replaced by it.
    """
    out = ["size", "source_size", "target", "taken"]
    keep = tuple(c for c in keep if c not in out)
    rows = docs.select(F.col(source_col).alias("_src"), F.xxhash64(F.lit(p.seed), F.col(order_col)).alias("_h"),
                       word_count(F.col(text_col)).alias("size"), *[F.col(c).alias(f"_keep_{c}") for c in keep])
    rows = written(rows, "mix-sizes")
    sources = (rows.groupBy(F.col("_src").alias("source"))
                   .agg(F.sum("size").cast("long").alias("source_size"), F.count(F.lit(1)).alias("docs")))
    sources = source_targets(sources, p).withColumn("_all", F.lit(0))
    blocks = round((sources.agg(F.sum("target")).first()[0] or 0.0) / p.block)
    sources = sources.withColumn("_seats", F.lit(blocks).cast("long"))
    sources = written(apportion(sources, ["_all"], "target", "_seats").withColumnRenamed("quota", "seats")
                      .withColumn("n_shards", F.ceil(F.greatest(F.col("source_size") / p.shard_words,
                                                                F.col("docs") / p.shard_docs, F.lit(1.0))).cast("long")),
                      "mix-quotas")
    named = sources.select(F.col("source").alias("_src"), "source_size", "target", "seats", "n_shards")
    rows = (rows.join(named, rows["_src"].eqNullSafe(named["_src"])).drop(named["_src"])
                .withColumn("_order", F.pmod(F.col("_h"), F.col("n_shards"))))
    shards = (rows.groupBy("_src", "_order").agg(F.sum("size").cast("double").alias("_words"),
                                                 F.first("seats").alias("seats")))
    shards = shards.withColumn("_src_key", F.coalesce(F.concat(F.lit("s"), "_src"), F.lit("n")))
    quota = written(apportion(shards, ["_src_key"], "_words", "seats").select("_src", "_order", "quota"), "mix-shards")
    rows = rows.join(quota.withColumnRenamed("_src", "_s2").withColumnRenamed("_order", "_o2"),
                     F.col("_src").eqNullSafe(F.col("_s2")) & (F.col("_order") == F.col("_o2"))).drop("_s2", "_o2")
    kept = [c for c in rows.columns if c.startswith("_keep_")]
    narrow = rows.select("_src", "_order", "_h", "size", "quota", "source_size", "target", *kept)
    schema = StructType([*narrow.schema.fields, StructField("taken", LongType())])

    def deal(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        order = np.lexsort((t.column("size").to_numpy(), t.column("_h").to_numpy()))
        t = t.take(pa.array(order))
        size = t.column("size").to_numpy()
        ends = np.cumsum(size)
        words, quota = int(ends[-1]), t.column("quota")[0].as_py()
        n = -(-words // p.block)
        taken = np.zeros(len(size), np.int64)
        if n:
            passes, rest = divmod(min(quota, p.max_repeat * n), n)
            rng = np.random.default_rng((p.seed, int(t.column("_order")[0].as_py()), words))
            times = np.full(n, passes, np.int64)
            times[rng.permutation(n)[:rest]] += 1
            # words taken up to every block edge, then up to every document edge
            width = np.full(n, p.block, np.int64)
            width[-1] = words - (n - 1) * p.block
            upto = np.concatenate(([0], np.cumsum(times * width)))

            def at(x):
                b = np.minimum(x // p.block, n - 1)
                return upto[b] + (x - b * p.block) * times[b]

            taken = at(ends) - at(ends - size)
        return t.append_column("taken", pa.array(taken))

    dealt = narrow.groupBy("_src", "_order").applyInArrow(deal, schema)
    return dealt.select(*[F.col(f"_keep_{c}").alias(c) for c in keep], *out)
