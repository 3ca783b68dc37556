"""All labelled texts dealt to shards for fitting a classifier; a bounded sample for a first look."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm._tables import key_filter, may_hold, prepare, written


def fold(id_col: str, parts: int):
    """crc32 of the id as text, modulo ``parts`` (null ids are in no fold)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, allowed, classes: int = 2, id_col: str = "doc_id",
                   text_col: str = "text", extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``(_id, _label, _h, _text, *extra)``: every whole text whose id has a label below
    ``classes`` and that ``allowed`` admits; ``_h`` is the text's hash. An id with two labels
    or texts has a row for each; repeated rows stay, their ``(_id, _label, _h)`` being equal.
    Null texts and null ids are left out. Texts without a label mostly stop at a filter of
    the labelled ids (a few megabytes, whatever their number), so few others move."""
    spark = docs.sparkSession
    prepare(spark)
    known = labels.filter(F.col(label_col).isin(*range(classes)))
    known = (known.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label"))
                  .filter(F.col("_id").isNotNull() & allowed("_id")).distinct())
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                      *[F.col(c).cast("string").alias(c) for c in extra])
    own = own.filter(F.col("_text").isNotNull() & F.col("_id").isNotNull() & allowed("_id"))
    own = own.select(F.xxhash64("_id").alias("_k"), *own.columns)
    bits = spark.sparkContext.broadcast(key_filter(known.select(F.xxhash64("_id").alias("_k")), "_k"))

    def likely(batches):
        for b in batches:
            yield b.filter(pa.array(may_hold(bits.value, b.column(0).to_numpy())))

    near = own.mapInArrow(likely, own.schema).drop("_k")
    return near.hint("merge").join(known, "_id").select("_id", "_label", F.xxhash64("_text").alias("_h"), "_text", *extra)


def totals(rows: DataFrame, size) -> dict[int, tuple[int, int]]:
    """Label -> rows of ``labelled_texts`` (repeated ones once) and the sum of their ``size``."""
    once = rows.groupBy("_id", "_label", "_h").agg(F.max(size).alias("_size"))
    got = once.groupBy("_label").agg(F.count(F.lit(1)).alias("n"), F.sum("_size").cast("long").alias("size")).collect()
    return {r["_label"]: (r["n"], r["size"]) for r in got}


def dealt(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with ``_shard``, in which hashes of id and text deal them evenly."""
    return rows.withColumn("_shard", F.pmod(F.xxhash64(F.lit(11), "_id", "_h"), F.lit(shards)).cast("int"))


def per_shard(rows: DataFrame, shards: int, fit, schema: str) -> DataFrame:
    """``fit(table)`` of each shard of ``dealt`` rows, one task a shard, in an order that does
    not depend on the input's; repeated rows come once. ``fit`` gives an Arrow batch."""
    key = ["_shard", "_h", "_id", "_label"]
    names = rows.columns
    at = [names.index(c) for c in key]

    def run(batches):
        parts, last = [], None
        for b in batches:
            keys = list(zip(*[b.column(i).to_pylist() for i in at]))
            start = 0
            for i, k in enumerate(keys):
                if last is not None and k[0] != last[0]:
                    parts.append(b.slice(start, i - start))
                    yield fit(pa.Table.from_batches(parts))
                    parts, start = [], i
                elif k == last:  # a repeated row
                    parts.append(b.slice(start, i - start))
                    start = i + 1
                last = k
            parts.append(b.slice(start))
        if last is not None:
            yield fit(pa.Table.from_batches(parts))

    return rows.repartitionById(shards, "_shard").sortWithinPartitions(*key).mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, allowed, per_class: tuple[int, int],
                    max_bytes: int, encode, budget: int, id_col: str = "doc_id", text_col: str = "text",
                    extra: tuple[str, ...] = ()):
    """Rows ``(encoded, label, *extra)`` on the driver: of the label rows that ``allowed``
    admits, at most ``per_class[0]`` with label 0 and ``per_class[1]`` with label 1, by a
    hash of their id (for a first look at a corpus: no query fits on it); texts above ``max_bytes`` and null texts are not used to fit.

    ``encode`` makes one ``bytes`` of each text of an Arrow column; it runs on the executors,
    and what reaches the driver stays within ``budget`` bytes (in the order of the hash). The
    ids are chosen before any text is touched, so only the sample's texts move. Of several
    texts under one id the one with the smallest hash counts.
    """
    prepare(docs.sparkSession)
    known = labels.filter(F.col(label_col).isin(*range(len(per_class))))
    known = (known.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("_label"))
                   .filter(F.col("_id").isNotNull() & allowed("_id")).distinct())
    draw = F.xxhash64(F.lit(11), "_id")
    totals = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()
              if r["_label"] in range(len(per_class))}
    # A first cut by hash leaves little more than the sample, so its sort stays small.
    share = {v: min(1.0, (1.3 * n + 50) / max(1, totals.get(v, 0))) for v, n in enumerate(per_class)}
    picked = reduce(DataFrame.unionByName, [
        known.filter((F.col("_label") == v) & (F.pmod(draw, F.lit(1 << 30)) < F.lit(int(share[v] * (1 << 30)))))
             .orderBy(draw, "_id").limit(n)
        for v, n in enumerate(per_class)])
    names = [f"_x{i}" for i in range(len(extra))]
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                      *[F.col(c).cast("string").alias(x) for c, x in zip(extra, names)])
    own = own.filter(F.octet_length("_text") <= max_bytes)
    first = F.min(F.struct(F.xxhash64("_text").alias("_h"), "_text", *names)).alias("_m")
    texts = own.join(F.broadcast(picked), "_id").groupBy("_id", "_label").agg(first)  # sum(per_class) ids at most

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(2 + len(names))), pa.array(encode(b.column(b.num_columns - 1)), pa.binary())],
                                             ["_id", "_label", *names, "_code"])

    schema = ", ".join(["_id long", "_label int", *(f"{x} string" for x in names), "_code binary"])
    coded = written(texts.select("_id", "_label", *[f"_m.{x}" for x in names], "_m._text").mapInArrow(run, schema), "labelled")
    # One row per text of the sample, whose number is a parameter.
    spent = F.sum(F.length("_code")).over(Window.orderBy(draw, "_id", "_label").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = coded.withColumn("_spent", spent).filter(F.col("_spent") <= budget).collect()
    rows.sort(key=lambda r: (r["_id"], r["_label"]))
    return [(bytes(r["_code"]), r["_label"], *(r[x] for x in names)) for r in rows]
