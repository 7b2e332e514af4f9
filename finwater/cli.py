"""Command line for the three jobs.

    spark-submit finwater/cli.py report --history PATH [--customers PATH] --out PATH
    python -m finwater report --local ...     # local session for a trial run

The session comes from ``spark-submit`` (master, resources, checkpoint
folder); ``--local`` builds a local one.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _session(local: bool) -> SparkSession:
    if local:
        from finwater.session import local_session

        return local_session()
    return SparkSession.builder.appName("finwater").getOrCreate()


def _write(df, out: str, fmt: str) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(out)
    else:
        writer.parquet(out)


def cmd_report(spark: SparkSession, a) -> dict:
    from pyspark.sql import functions as F

    from finwater.plans.client_financials import client_financials
    from finwater.sources.resolve import read_source
    from finwater.sources.statements import read_statements, snapshot_dates

    stmts = read_statements(spark, a.history)
    as_of = dt.date.fromisoformat(a.as_of) if a.as_of else None
    if as_of is None and a.partitioned:
        dates = snapshot_dates(spark, a.history)
        as_of = dates[-1] if dates else None
    customers = None
    if a.customers:
        customers = read_source(spark, a.customers).select(F.col(a.customer_id).cast("bigint").alias("customerid"))
    window = (dt.date.fromisoformat(a.report_date), a.window_months) if a.window_months else None
    df = client_financials(stmts, customers, as_of=as_of, snapshots=a.snapshots, window=window)
    _write(df, a.out, a.format)
    return {"job": "report", "out": a.out, "as_of": str(as_of)}


def cmd_load(spark: SparkSession, a) -> dict:
    from finwater.plans.rep_load import load_rep_target_table, load_rep_targets
    from finwater.sources.csv_drop import DropFormat

    fmt = DropFormat(
        encoding=a.encoding, sep=a.sep, header=a.header, quote=a.quote, line_sep=a.line_sep,
        skip_header_rows=a.skip_header_rows, skip_rows=a.skip_rows,
    )
    load, to = (load_rep_target_table, a.table) if a.table else (load_rep_targets, a.target)
    df = load(spark, a.drop, to, policy=a.policy, quarantine_path=a.quarantine, name_width=a.name_width, fmt=fmt)
    return {"job": "load", "rows": df.count()}


def cmd_find_columns(spark: SparkSession, a) -> dict:
    from finwater.operators.columns import find_columns
    from finwater.sources.catalog import columns_from_catalog, columns_from_parquet_dir

    meta = columns_from_parquet_dir(spark, a.parquet_dir) if a.parquet_dir else columns_from_catalog(spark)
    rows = find_columns(meta, a.pattern, catalog=a.catalog, case_sensitive=a.case_sensitive).collect()
    return {"job": "find-columns", "matches": [[r["TableName"], r["ColumnName"]] for r in rows]}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="finwater")
    p.add_argument("--local", action="store_true", help="build a local session (trial runs)")
    sub = p.add_subparsers(dest="cmd", required=True)

    r = sub.add_parser("report", help="client-financials report")
    r.add_argument("--history", required=True, help="statement history: a Parquet folder or a table name of up to three parts, partitioned by asofdate")
    r.add_argument("--customers", help="customer table: a Parquet folder or a table name")
    r.add_argument("--customer-id", default="customerid")
    r.add_argument("--snapshots", choices=["latest", "all"], default="latest")
    r.add_argument("--as-of", help="snapshot date (default: newest)")
    r.add_argument("--no-partitioned", dest="partitioned", action="store_false",
                   help="history is not partitioned by asofdate (newest date by a max job)")
    r.add_argument("--report-date", default=str(dt.date.today()))
    r.add_argument("--window-months", type=int, help="keep statements dated within N months of the report date")
    r.add_argument("--out", required=True)
    r.add_argument("--format", choices=["parquet", "csv"], default="parquet")

    ld = sub.add_parser("load", help="sales-target CSV drop load")
    ld.add_argument("--drop", required=True)
    ld.add_argument("--target", help="target folder (parquet)")
    ld.add_argument("--table", help="target catalog table instead of a folder")
    ld.add_argument("--policy", choices=["strict", "quarantine"], default="strict")
    ld.add_argument("--quarantine")
    ld.add_argument("--name-width", type=int, default=50)
    ld.add_argument("--encoding", default="windows-1252")
    ld.add_argument("--sep", default=",", help="column delimiter")
    ld.add_argument("--quote", help="text qualifier (default: none)")
    ld.add_argument("--line-sep", default="\r\n", help="row delimiter (default: CR LF)")
    ld.add_argument("--no-header", dest="header", action="store_false", help="no column names in the first row")
    ld.add_argument("--skip-header-rows", type=int, default=0, help="lines to leave out before the header")
    ld.add_argument("--skip-rows", type=int, default=0, help="data lines to leave out after the header")

    f = sub.add_parser("find-columns", help="tables holding a column matching a LIKE pattern")
    f.add_argument("--pattern", required=True)
    f.add_argument("--parquet-dir", help="folder of <table>.parquet datasets (default: session catalog)")
    f.add_argument("--catalog")
    f.add_argument("--case-sensitive", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    if a.cmd == "load" and not (a.target or a.table):
        raise SystemExit("load needs --target or --table")
    if a.cmd == "load" and a.policy == "quarantine" and not a.quarantine:
        raise SystemExit("--policy quarantine needs --quarantine")
    spark = spark or _session(a.local)
    result = {"report": cmd_report, "load": cmd_load, "find-columns": cmd_find_columns}[a.cmd](spark, a)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
