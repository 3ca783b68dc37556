"""Declarative data-quality rules.

A rule counts violations; zero violations = pass. Counting follows the public
semantics of the common column tests:

* ``not_null``         — rows where the column is NULL;
* ``unique``           — distinct non-NULL values that occur more than once;
* ``accepted_values``  — distinct non-NULL values outside the list (NULL passes);
* ``relationships``    — non-NULL child rows whose key is missing from the parent.

``run_suite`` fuses every ``not_null``/``accepted_values`` rule of a table into one
aggregate (one scan per table, not one per rule), answers a ``not_null`` next to a
``unique`` on the same column from the unique rule's per-value aggregate, and
pre-aggregates ``unique`` and ``relationships`` per key before shuffling, so a key
holding a third of all rows is reduced map-side.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.constants import INGESTED_AT

RESULT_COLUMNS = ("table_name", "column_name", "rule", "violations", "passed")


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    kind: str
    values: tuple = ()
    to_table: str | None = None
    to_column: str | None = None


def not_null(table: str, column: str) -> Rule:
    return Rule(table, column, "not_null")


def unique(table: str, column: str) -> Rule:
    return Rule(table, column, "unique")


def accepted_values(table: str, column: str, values: Sequence) -> Rule:
    return Rule(table, column, "accepted_values", tuple(values))


def relationships(table: str, column: str, to_table: str, to_column: str) -> Rule:
    return Rule(table, column, "relationships", (), to_table, to_column)


def rules_from_spec(spec, ref_prefix: str = "ref(") -> list[Rule]:
    """Rules from a declarative spec: ``{"models": [{"name", "columns": [{"name",
    "tests": [...]}]}]}`` — the usual shape of column-test declarations. A test is
    ``"not_null"``, ``"unique"``, ``{"accepted_values": {"values": [...]}}`` or
    ``{"relationships": {"to": "ref('parent')", "field": "key"}}`` (arguments may
    also sit under an ``arguments`` key). ``spec`` may be YAML text (PyYAML needed).
    """
    if isinstance(spec, str):
        import yaml  # optional dependency, only for YAML text

        spec = yaml.safe_load(spec)
    rules: list[Rule] = []
    for model in spec.get("models", []):
        table = model["name"]
        for column in model.get("columns", []):
            for test in column.get("tests", []) or []:
                if isinstance(test, str):
                    kind, args = test, {}
                else:
                    (kind, args), = test.items()
                    args = dict(args or {})
                    args = dict(args.get("arguments", {}), **{k: v for k, v in args.items()
                                                               if k != "arguments"})
                name = column["name"]
                if kind == "not_null":
                    rules.append(not_null(table, name))
                elif kind == "unique":
                    rules.append(unique(table, name))
                elif kind == "accepted_values":
                    rules.append(accepted_values(table, name, args["values"]))
                elif kind == "relationships":
                    to = str(args["to"]).strip()
                    if to.startswith(ref_prefix):
                        to = to[len(ref_prefix):].rstrip(")").strip().strip("'\"")
                    rules.append(relationships(table, name, to, args["field"]))
                else:
                    raise ValueError(f"unknown test {kind!r} on {table}.{name}")
    return rules


def _result(rule: Rule, violations: Column) -> Column:
    v = F.coalesce(violations.cast("bigint"), F.lit(0).cast("bigint"))
    return F.struct(F.lit(rule.table).alias("table_name"), F.lit(rule.column).alias("column_name"),
                    F.lit(rule.kind).alias("rule"), v.alias("violations"),
                    (v == 0).alias("passed"))


def _explode_results(row: DataFrame, results: list[Column]) -> DataFrame:
    return row.select(F.explode(F.array(*results)).alias("_r")).select("_r.*")


def _fused_row_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """not_null and accepted_values of one table in a single aggregate."""
    aggs, results = [], []
    for i, r in enumerate(rules):
        col = F.col(r.column)
        if r.kind == "not_null":
            aggs.append(F.count(F.when(col.isNull(), F.lit(1))).alias(f"_v{i}"))
        else:
            bad = F.when(col.isNotNull() & ~col.isin(*r.values), col)
            aggs.append(F.count_distinct(bad).alias(f"_v{i}"))
        results.append(_result(r, F.col(f"_v{i}")))
    return _explode_results(df.agg(*aggs), results)


def _unique_rule(df: DataFrame, rule: Rule, not_null_rule: Rule | None = None) -> DataFrame:
    """Values occurring more than once; with ``not_null_rule`` on the same column the
    NULL count comes from the same per-value aggregate (NULL is one group)."""
    col = F.col(rule.column)
    per_value = df.groupBy(col.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    row = per_value.agg(
        F.count(F.when(F.col("_v").isNotNull() & (F.col("_n") > 1), F.lit(1))).alias("_dup"),
        F.sum(F.when(F.col("_v").isNull(), F.col("_n"))).alias("_nulls"))
    results = [_result(rule, F.col("_dup"))]
    if not_null_rule is not None:
        results.insert(0, _result(not_null_rule, F.col("_nulls")))
    return _explode_results(row, results)


def _relationship_rule(child: DataFrame, parent: DataFrame, rule: Rule) -> DataFrame:
    col = F.col(rule.column)
    per_key = child.filter(col.isNotNull()).groupBy(col.alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"))
    parent_keys = parent.select(F.col(rule.to_column).alias("_k")).distinct()
    orphans = per_key.join(parent_keys, "_k", "left_anti")
    return _explode_results(orphans.agg(F.sum("_n").alias("_v")), [_result(rule, F.col("_v"))])


def run_suite(tables: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """Evaluate every rule; one result row per rule:
    ``(table_name, column_name, rule, violations, passed)``.

    Per table: a ``unique`` rule and a ``not_null`` rule on the same column share one
    per-value aggregate; the remaining ``not_null``/``accepted_values`` rules share
    one fused aggregate; each ``relationships`` rule is a pre-aggregated anti join.
    """
    parts: list[DataFrame] = []
    unique_cols = {(r.table, r.column) for r in rules if r.kind == "unique"}
    paired = {(r.table, r.column): r for r in rules
              if r.kind == "not_null" and (r.table, r.column) in unique_cols}
    row_rules: dict[str, list[Rule]] = defaultdict(list)
    for r in rules:
        if r.kind == "not_null" and (r.table, r.column) in paired:
            continue  # answered by the unique rule's aggregate
        if r.kind in ("not_null", "accepted_values"):
            row_rules[r.table].append(r)
        elif r.kind == "unique":
            parts.append(_unique_rule(tables[r.table], r, paired.get((r.table, r.column))))
        elif r.kind == "relationships":
            parts.append(_relationship_rule(tables[r.table], tables[r.to_table], r))
        else:
            raise ValueError(f"unknown rule kind {r.kind!r}")
    for table, rs in row_rules.items():
        parts.insert(0, _fused_row_rules(tables[table], rs))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ingestion_checks(source: DataFrame, bronze: DataFrame, required: Sequence[str],
                     stamp: str = INGESTED_AT, records: DataFrame | None = None) -> DataFrame:
    """Bronze invariants: same row count as the source, stamp column present,
    required columns present. Rows ``(check_name, expected, actual, passed)``.

    Both counts come from one aggregate over a tagged union (no join of counts).
    ``records`` (one row ``n``) is the source's count taken on its raw text, before any
    parsing; without it the rows of ``source`` are counted.
    """
    left = source.select(F.lit(1).alias("_s")) if records is None else records.select(F.col("n").alias("_s"))
    tagged = (left.select("_s", F.lit(0).alias("_b"))
              .unionByName(bronze.select(F.lit(0).alias("_s"), F.lit(1).alias("_b"))))
    counts = tagged.agg(F.sum("_s").cast("bigint").alias("_src"),
                        F.sum("_b").cast("bigint").alias("_brz"))
    cols = set(bronze.columns)
    missing = [c for c in required if c not in cols]

    def check(name, expected, actual):
        return F.struct(F.lit(name).alias("check_name"), expected.cast("string").alias("expected"),
                        actual.cast("string").alias("actual"), (expected.cast("string") ==
                                                                actual.cast("string")).alias("passed"))

    results = [
        check("row_count", F.coalesce(F.col("_src"), F.lit(0)), F.coalesce(F.col("_brz"), F.lit(0))),
        check("stamp_column", F.lit(stamp), F.lit(stamp if stamp in cols else "")),
        check("required_columns", F.lit(",".join(required)),
              F.lit(",".join(c for c in required if c in cols)) if not missing else
              F.lit("missing:" + ",".join(missing))),
    ]
    return _explode_results(counts, results)
