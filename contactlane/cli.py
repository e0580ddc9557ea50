"""Command-line jobs for scheduled batch runs (``python -m contactlane ...``).

Each command reads tables, runs one job on Spark and prints a JSON line of
row counts; nothing else is collected to the driver.

    directory --ids PATH [--id-col sap_id] --out PATH
    intake    --emails PATH --directory PATH --out PATH [--materialize-extraction] [--sample N]
    review    --queue PATH --emails PATH --warehouse PATH [--database DB] --actor EMAIL
    report    {kpi,pending,audit,followups,turnaround} --queue PATH --warehouse PATH
              [--database DB] --out PATH [--format parquet|csv] [--limit N] [--search TEXT]
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _stamp(value: str | None):
    if value:
        return F.lit(value).cast("timestamp_ntz")
    return F.current_timestamp().cast("timestamp_ntz")


def _table(spark: SparkSession, database: str | None, name: str) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


def _write(df: DataFrame, path: str, fmt: str) -> int:
    from pyspark.sql import Observation

    from .sources.tables import CSV_STAMPS

    obs = Observation("report")
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if fmt == "csv":
        df.write.mode("overwrite").options(header=True, **CSV_STAMPS).csv(path)
    else:
        df.write.mode("overwrite").parquet(path)
    return obs.get["rows"]


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="contactlane")
    ap.add_argument("--as-of", help="run stamp (default: now, UTC)")
    sub = ap.add_subparsers(dest="command", required=True)

    d = sub.add_parser("directory", help="rebuild the account directory from raw ids")
    d.add_argument("--ids", required=True)
    d.add_argument("--id-col", default="sap_id")
    d.add_argument("--out", required=True)

    i = sub.add_parser("intake", help="extract, validate, look up, route, write the queue")
    i.add_argument("--emails", required=True)
    i.add_argument("--directory", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--materialize-extraction", action="store_true")
    i.add_argument("--sample", type=int)

    r = sub.add_parser("review", help="decide all pending items and append the outputs")
    r.add_argument("--queue", required=True)
    r.add_argument("--emails", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--database")
    r.add_argument("--actor", required=True)

    p = sub.add_parser("report", help="write a review report")
    p.add_argument("name", choices=["kpi", "pending", "audit", "followups", "turnaround"])
    p.add_argument("--queue")
    p.add_argument("--warehouse", required=True)
    p.add_argument("--database")
    p.add_argument("--out", required=True)
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    p.add_argument("--limit", type=int)
    p.add_argument("--search")
    return ap


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from .operators import audit as A
    from .operators import queue as Q
    from .plans import intake
    from .session import build_session
    from .sources import tables

    args = parser().parse_args(argv)
    spark = spark or build_session()
    as_of = _stamp(args.as_of)
    if args.command == "directory":
        ids = spark.read.parquet(args.ids)
        result = {"rows": intake.run_directory_refresh(ids, args.out, as_of, args.id_col)}
    elif args.command == "intake":
        emails = tables.read_emails(spark, args.emails)
        if args.sample:
            emails = intake.first_n(emails, args.sample)
        result = intake.run_intake(emails, spark.read.parquet(args.directory), args.out, as_of,
                                   materialize_extraction=args.materialize_extraction)
    elif args.command == "review":
        tables.ensure_tables(spark, args.warehouse, database=args.database)
        names = {k: _table(spark, args.database, k)
                 for k in ("approved_changes", "outgoing_emails", "review_actions")}
        result = intake.run_review(tables.read_queue(spark, args.queue),
                                   tables.read_emails(spark, args.emails), args.actor, as_of,
                                   names["approved_changes"], names["outgoing_emails"],
                                   names["review_actions"])
    else:
        tables.ensure_tables(spark, args.warehouse, database=args.database)
        actions = spark.table(_table(spark, args.database, "review_actions"))
        outgoing = spark.table(_table(spark, args.database, "outgoing_emails"))
        if args.name in ("kpi", "pending", "turnaround") and not args.queue:
            raise SystemExit(f"report {args.name} needs --queue")
        if args.name == "kpi":
            df = Q.kpi_counts(Q.pending(tables.read_queue(spark, args.queue), actions))
        elif args.name == "pending":
            df = Q.pending_items(tables.read_queue(spark, args.queue), actions, args.search,
                                 limit=args.limit)
        elif args.name == "audit":
            df = A.audit_log(actions, args.limit)
        elif args.name == "followups":
            df = A.followup_list(outgoing, args.limit)
        else:
            df = A.turnaround(tables.read_queue(spark, args.queue), actions)
        result = {"rows": _write(df, args.out, args.format)}
    out = {"command": args.command, **result}
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
