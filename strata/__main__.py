"""Command line: build a lakehouse from extracts, or run a report over a built one.

    python -m strata build --root /lake --cases csv:/in/cases.csv \\
        --districts csv:/in/districts.csv --classes csv:/in/classes.csv \\
        --events json:/in/events.json [--incremental] [--today 2025-01-01]
    python -m strata report by_district_class_year --root /lake [--out /reports/flagship]
"""

from __future__ import annotations

import argparse
import sys


def _source(text: str) -> tuple[str, str]:
    fmt, _, path = text.partition(":")
    if fmt not in ("csv", "json") or not path:
        raise argparse.ArgumentTypeError("expected csv:<path> or json:<path>")
    return fmt, path


def _show(df) -> None:
    """Print every row of a report (streamed partition by partition)."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def _columns(entries) -> dict[str, dict[str, str]]:
    """``role.column=name`` entries over the model's own column names."""
    from strata.plans.lakehouse import DEFAULT_COLUMNS

    out = {role: {c: c for c in cols} for role, cols in DEFAULT_COLUMNS.items()}
    for entry in entries or ():
        target, eq, name = entry.partition("=")
        role, dot, column = target.partition(".")
        if not (eq and dot and column in out.get(role, {})):
            raise SystemExit(f"--column {entry}: expected role.column=name, one of "
                             + ", ".join(f"{r}.{c}" for r, cs in out.items() for c in cs))
        out[role][column] = name
    return out


def main(argv=None) -> int:
    from strata.plans.sql_reports import REPORTS

    parser = argparse.ArgumentParser(prog="python -m strata")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="extracts -> bronze -> silver -> gold -> quality report")
    b.add_argument("--root", required=True)
    for role in ("cases", "districts", "classes", "events"):
        b.add_argument(f"--{role}", type=_source, required=role != "events")
    b.add_argument("--incremental", action="store_true")
    b.add_argument("--splittable", action="store_true",
                   help="JSON-lines and single-line CSV: split large files across tasks")
    b.add_argument("--splits", action="store_true",
                   help="JSON arrays and CSV with quoted line ends, read in splits")
    b.add_argument("--extract-folders", action="store_true",
                   help="with --incremental: an extract is a folder of files, newest by name")
    b.add_argument("--column", action="append", metavar="ROLE.COLUMN=NAME",
                   help="an extract's own name of a model column, e.g. cases.case_id=number")
    b.add_argument("--today", default=None)
    b.add_argument("--rules", default=None,
                   help="YAML file of models/columns/tests (default: the model's 20 rules)")
    r = sub.add_parser("report", help="run a duration report over a built lakehouse")
    r.add_argument("name", choices=sorted(REPORTS))
    r.add_argument("--root", required=True)
    r.add_argument("--min-support", type=int, default=3)
    r.add_argument("--out", default=None, help="write the report as Parquet instead of showing it")
    args = parser.parse_args(argv)

    from strata.session import build_session

    spark = build_session()
    if args.command == "build":
        from strata.plans.lakehouse import build_lakehouse

        sources = {role: getattr(args, role) for role in ("cases", "districts", "classes", "events")
                   if getattr(args, role)}
        form = "split" if args.splits else not args.splittable
        rules = None
        if args.rules:
            from strata.operators.quality import rules_from_spec

            with open(args.rules, encoding="utf-8") as f:
                rules = rules_from_spec(f.read())
        lake = build_lakehouse(spark, sources, args.root, columns=_columns(args.column), today=args.today, rules=rules,
                               incremental=args.incremental, json_array=form, csv_multiline=form,
                               extract_folders=args.extract_folders)
        _show(lake.quality.orderBy("table_name", "column_name", "rule"))
        return 0
    from strata.plans.lakehouse import open_lakehouse
    from strata.plans.sql_reports import run_report, serve_views

    serve_views(open_lakehouse(spark, args.root))
    result = run_report(spark, args.name, min_support=args.min_support)
    if args.out:
        result.write.mode("overwrite").parquet(args.out)
    else:
        _show(result)
    return 0


if __name__ == "__main__":
    sys.exit(main())
