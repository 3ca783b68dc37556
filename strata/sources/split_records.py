"""Records of large text files read in splits, where a record may hold line ends.

Spark's multi-line readers take a whole file in one task. Here a file is read in pieces
(lines of a CSV, text up to each ``}`` of a JSON array) by as many tasks as it has splits:

1. every split is scanned once without knowing what came before it. Its effect is a small
   fact: how it changes "inside quotes", and the nesting depth it adds if it starts outside
   or inside quotes;
2. a running fold over these facts, one row a split, gives every split its state at its start;
3. the splits are scanned again from that state and cut into records. A record that crosses
   the border of splits leaves its fragments, at most two a split; only these are shuffled
   and joined in order.

No text is held beyond a batch and the record being read; a hot file is as many tasks as any
other bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.constants import PANDAS_NA_TOKENS
from strata.sources.text_files import (
    CORRUPT,
    Columns,
    checked,
    column_mapping,
    csv_header,
    null_tokens_to_null,
    renamed,
    surplus_fields,
    unreadable_json,
)


@dataclass(frozen=True)
class Form:
    """How a text is cut: ``separator`` ends a piece; ``scan(pieces, quoted, depth)`` says
    after which pieces a record ends, and the state after the last one."""

    separator: str
    scan: Callable[[pa.Array, int, int], tuple[np.ndarray, int, int]]
    close: str = ""  # the separator belongs to the record it ends


def _bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = col.cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def _csv_scan(pieces: pa.Array, quoted: int, depth: int):
    """A line ends a record where the quotes up to its end are even (``""`` counts twice)."""
    quotes = pc.count_substring(pieces, '"').to_numpy(zero_copy_only=False)
    state = (quoted + np.cumsum(quotes)) & 1
    return state == 0, int(state[-1]) if len(state) else quoted, depth


def _json_scan(pieces: pa.Array, quoted: int, depth: int):
    """A ``}`` outside strings that leads back to depth 1 ends an element of the array."""
    raw, offs = _bytes(pc.replace_substring_regex(pieces, r"\\.", ""))
    inside = ((quoted + np.cumsum(raw == 34)) & 1).astype(bool)
    step = np.where(inside, 0, ((raw == 91) | (raw == 123)).astype(np.int64) - (raw == 93) - (raw == 125))
    total = np.concatenate(([0], np.cumsum(step)))
    ends = np.concatenate(([bool(quoted)], inside))[offs[1:]]
    after = depth + total[offs[1:]] - np.cumsum(~ends)  # the separator closes an object
    return ~ends & (after == 1), int(ends[-1]) if len(ends) else quoted, int(after[-1]) if len(after) else depth


CSV = Form("\n", _csv_scan)
JSON_ARRAY = Form("}", _json_scan, "}")


def _pieces(spark: SparkSession, path: str, form: Form) -> DataFrame:
    text = spark.read.option("lineSep", form.separator).text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _by_split(batches, form: Form):
    """``(file, block, pieces)`` runs of the batches, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        cut = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for lo, hi in zip(np.append(0, cut), np.append(cut, batch.num_rows)):
            yield int(file[lo]), int(block[lo]), batch.column(2).slice(lo, hi - lo)


def split_states(spark: SparkSession, path: str, form: Form) -> DataFrame:
    """``(file, block, quoted, depth, final)``: the state at the start of every split, and
    whether it is its file's last."""
    def scan(batches):
        seen: dict[tuple[int, int], list[int]] = {}
        for file, block, pieces in _by_split(batches, form):
            # state and depth so far, had the split started outside or inside quotes
            s = seen.setdefault((file, block), [0, 0, 1, 0])
            _, s[0], s[1] = form.scan(pieces, s[0], s[1])
            _, s[2], s[3] = form.scan(pieces, s[2], s[3])
        if seen:
            rows = np.array([(f, b, s[0], s[1], s[3]) for (f, b), s in seen.items()], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], ["file", "block", "flips", "outside", "inside"])

    facts = _pieces(spark, path, form).mapInArrow(scan, "file long, block long, flips long, outside long, inside long")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    told = facts.withColumn("quoted", F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2)
    step = F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))
    return told.withColumn("step", step).select("file", "block", "quoted", F.coalesce(F.sum("step").over(before), F.lit(0)).alias("depth"),
                                                  (F.col("block") == F.max("block").over(Window.partitionBy("file"))).alias("final"))


def split_records(spark: SparkSession, path: str, form: Form) -> DataFrame:
    """``(file, first, text)``: the records of all files, whole; ``first`` marks a file's first.

    An unclosed rest at the end of a file is a record as it stands (of a JSON array that is
    cut off, what follows the last ``}`` but one).
    """
    # One row of four numbers per split of the input (128 MB, as a rule).
    start = {(r.file, r.block): (r.quoted, r.depth, r.final) for r in split_states(spark, path, form).collect()}
    shared = spark.sparkContext.broadcast(start)

    def rows(file, block, part, texts, whole):
        n = len(texts)
        return pa.RecordBatch.from_arrays([pa.array([file] * n, pa.int64()), pa.array([block] * n, pa.int64()), pa.array(part, pa.int32()),
                                           pa.array([whole] * n), texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())],
                                          ["file", "block", "part", "whole", "text"])

    def cut(batches):
        states = shared.value
        at, held, quoted, depth, opened, seen, final, end = None, [], 0, 0, False, 0, False, None

        def leftover():
            # part 0: goes on from the split before; 1: begins here; -1: as the split's first record
            return rows(*at, [0 if opened else 1 if seen else -1], [form.separator.join(held)], False)

        for file, block, pieces in _by_split(batches, form):
            if at != (file, block):
                held += end.to_pylist() if end else []
                if held:
                    yield leftover()
                at, held, seen, end = (file, block), [], 0, None
                quoted, depth, final = states[at]
                opened = bool(quoted) or depth > 1
            if final and form.close:  # no separator stands after a file's last piece
                pieces = pa.concat_arrays([end, pieces]) if end else pieces
                pieces, end = pieces.slice(0, len(pieces) - 1), pieces.slice(len(pieces) - 1)
            ends, quoted, depth = form.scan(pieces, quoted, depth)
            last = np.flatnonzero(ends)
            if not len(last):
                held += pieces.to_pylist()
                continue
            first = np.concatenate(([0], last[:-1] + 1))
            if held or opened:  # the record that was open closes here
                text = form.separator.join([*held, *pieces.slice(0, int(last[0]) + 1).to_pylist()]) + form.close
                yield rows(*at, [0 if opened else 2 + seen], [text], not opened)
                seen, held, opened, first, last = seen + 1, [], False, first[1:], last[1:]
            texts = pieces.take(pa.array(first))
            longer = np.flatnonzero(last > first)
            if len(longer) or form.close:
                texts = texts.to_pylist()
                for k in longer.tolist():
                    texts[k] = form.separator.join(pieces.slice(int(first[k]), int(last[k] - first[k]) + 1).to_pylist())
                texts = [t + form.close for t in texts]
            if len(texts):
                yield rows(*at, np.arange(2 + seen, 2 + seen + len(texts)).clip(max=1 << 30), texts, True)
                seen += len(texts)
            done = int(np.flatnonzero(ends)[-1]) + 1
            held = pieces.slice(done).to_pylist()
        held += end.to_pylist() if end else []
        if held:
            yield leftover()

    got = _pieces(spark, path, form).mapInArrow(cut, "file long, block long, part int, whole boolean, text string")
    whole = got.filter("whole").select("file", ((F.col("block") == 0) & (F.col("part") == 2)).alias("first"), "text")
    # Fragments: at most two a split. A fragment that begins a record opens a group, the others go on with it.
    bits = got.filter("not whole").withColumn("g", F.sum((F.col("part") != 0).cast("int")).over(
        Window.partitionBy("file").orderBy("block", "part")))
    joined = bits.groupBy("file", "g").agg(
        F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("b"),
        F.max((F.col("block") == 0) & (F.col("part") == -1)).alias("first"))
    return whole.unionByName(joined.select("file", "first", F.array_join("b.text", form.separator).alias("text")))


def read_csv_records(spark: SparkSession, path: str, columns: Columns | None = None, null_tokens: Sequence[str] | None = PANDAS_NA_TOKENS,
                     on_malformed: str = "fail") -> DataFrame:
    """``read_csv_text`` with quoted line ends, files read in splits.

    Each file's first record is its header; ``columns`` names (or maps) the columns that must
    be in it. Files whose headers differ are an error, found while they are read, as are malformed records unless
    ``on_malformed`` puts them aside. Blank lines outside quotes are no records.
    """
    header = csv_header(spark, path)
    mapping = column_mapping(columns if columns is not None else header)
    missing = [src for src in mapping.values() if src not in header]
    if missing:
        raise ValueError(f"columns {missing} are not in the header {header} of {path}")
    records = split_records(spark, path, CSV).withColumn("text", F.regexp_replace("text", r"\r$", ""))
    records = records.filter(~F.regexp_like("text", F.lit(r"^\s*$")))
    schema = ", ".join(f"`{c}` string" for c in [*header, CORRUPT])
    parsed = F.from_csv("text", schema, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    df = records.select("first", "text", parsed.alias("r"))
    # a name that the header leaves empty is known by its place
    names = F.array(*[F.coalesce(F.col("r")[c], F.lit(f"_c{i}")) for i, c in enumerate(header)])
    same = F.when(names == F.array(*map(F.lit, header)), F.lit(False))
    df = df.filter(F.when(~F.col("first"), F.lit(True)).otherwise(F.coalesce(same, F.raise_error(F.concat(
        F.lit(f"a file's header is not {header}: "), "text")).cast("boolean")))).select("r.*")
    df = renamed(checked(df, surplus_fields(len(header)), "CSV", on_malformed), mapping)
    return null_tokens_to_null(df, null_tokens, [c for c in df.columns if c != CORRUPT]) if null_tokens else df


def read_json_array_records(spark: SparkSession, path: str, columns: Columns, on_malformed: str = "fail") -> DataFrame:
    """``read_json_text(array=True)`` for arrays of objects, files read in splits.

    ``columns`` names the keys (or maps ``target -> key``). What stands between the objects
    of an array must be commas and blanks; anything else goes with the object after it and
    makes that record malformed.
    """
    records = split_records(spark, path, JSON_ARRAY)
    # a file's first record carries the array's bracket, the others their comma
    text = F.regexp_replace("text", r"^\s*[\[,]?\s*", "")
    records = records.select(text.alias("text")).filter(~F.regexp_like("text", F.lit(r"^\s*\]?\s*$")))
    mapping = column_mapping(columns)
    names = [*mapping.values(), CORRUPT]
    parsed = records.select(F.from_json("text", ", ".join(f"`{c}` string" for c in names),
                                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r")).select("r.*")
    return renamed(checked(parsed, unreadable_json(list(mapping.values())), "JSON", on_malformed), mapping)


def count_split_records(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """``(n)``: records of CSV files (headers and blank lines left out) or JSON arrays, counted
    on their text in splits, before any parsing."""
    if fmt == "csv":
        records = split_records(spark, path, CSV).filter(~F.regexp_like("text", F.lit(r"^\s*$")) & ~F.col("first"))
    else:
        records = split_records(spark, path, JSON_ARRAY).filter(~F.regexp_like("text", F.lit(r"^[\s,\[\]]*$")))
    return records.agg(F.count(F.lit(1)).alias("n"))
