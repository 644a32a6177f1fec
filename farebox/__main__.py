"""Command line: load, backfill, schedule, watch, check and query."""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import DataFrame

from .functions.months import month_span, parse_month
from .functions.scalar import utc_now
from .operators.clean import violation_counts
from .operators.views import register_views
from .plans import jobs
from .schema import LEDGER_TABLE, MONTH_COLUMN, PUBLICATION_LAG_MONTHS, TABLE_COLUMNS
from .session import build_session
from .sources import arrow_sink
from .sources.ledger import RunLedger
from .sources.tables import LAYOUTS, Layout, TripTable, read_quarantine


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="farebox", description=__doc__)
    parser.add_argument("--master", default=None)
    parser.add_argument("--table", required=True, help="path of the trip table")
    parser.add_argument("--ledger", required=True, help="path of the run ledger")
    parser.add_argument("--summary", default=None, help="path of the stored summary, if kept")
    parser.add_argument("--quarantine", default=None, help="path for rejected trips, if kept")
    parser.add_argument("--raw", default=None, help="folder of the raw month files")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("create", help="create an empty trip table")
    load = commands.add_parser("load", help="load months of one year")
    load.add_argument("--year", type=int, required=True)
    load.add_argument("--month", "--months", dest="months", required=True, help="1, 1-3 or 1,4,7")
    fill = commands.add_parser("backfill", help="load a span of months")
    fill.add_argument("--from", dest="first", required=True, help="YYYY-MM")
    fill.add_argument("--to", dest="last", default=None, help="YYYY-MM, this month by default")
    due = commands.add_parser("scheduled", help="load and check the month due today")
    due.add_argument("--run-date", type=date.fromisoformat, default=None)
    due.add_argument("--lag", type=int, default=PUBLICATION_LAG_MONTHS)
    watch = commands.add_parser("watch", help="load months whose files are new")
    watch.add_argument("--checkpoint", default=None)
    for loading in (load, fill, due, watch):
        loading.add_argument("--layout", choices=LAYOUTS, default="as_read")
        loading.add_argument("--sort-by-time", action="store_true", help="sort each file by pickup")
        loading.add_argument("--max-records-per-file", type=int, default=0)
    drop = commands.add_parser("delete", help="delete months from the trip table")
    drop.add_argument("--from", dest="first", required=True, help="YYYY-MM")
    drop.add_argument("--to", dest="last", required=True, help="YYYY-MM")
    out = commands.add_parser("export", help="export the trips as CSV files")
    out.add_argument("folder")
    out.add_argument("--from", dest="first", default=None, help="YYYY-MM")
    out.add_argument("--to", dest="last", default=None, help="YYYY-MM, the same as --from by default")
    commands.add_parser("rejected", help="rejected trips per month and broken rules")
    gate = commands.add_parser("quality", help="quality gate for one month")
    gate.add_argument("month", help="YYYY-MM")
    commands.add_parser("health", help="health checks")
    query = commands.add_parser("sql", help="run SQL over the trips and the views")
    query.add_argument("text")
    query.add_argument("--limit", type=int, default=None, help="print so many rows at most")
    query.add_argument("--out", default=None, help="write the rows there as Parquet instead")
    return parser


def _report(result: jobs.LoadResult) -> None:
    for month, rows in sorted(result.rows.items()):
        apart = f", {result.quarantined[month]:,} rejected" if result.quarantined else ""
        print(f"{month:%Y-%m}  {rows:,} rows of {result.raw[month]:,}{apart}")
    for month in result.missing:
        print(f"{month:%Y-%m}  no file, skipped")
    for entry in result.rejected:
        print(f"{entry.file.month:%Y-%m}  skipped, {entry.file.path} {entry.reason}")
    for name, count in result.nulled.items():
        if count:
            print(f"{count:,} values of {name} did not fit and are NULL")
    if result.summary_error:
        print(f"summary not refreshed: {result.summary_error}")
    print(f"{result.total:,} rows in {result.seconds:.1f} s")


def _print_rows(frame: DataFrame) -> None:
    """All rows, one partition at a time."""
    line = lambda values: print("|" + "|".join(map(str, values)) + "|")
    line(frame.columns)
    for row in frame.toLocalIterator():
        line("NULL" if v is None else v for v in row)


def main(argv: list[str] | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    loads = args.command in ("load", "backfill", "scheduled", "watch")
    if loads and not args.raw:
        parser.error(f"{args.command} needs --raw")
    layout = Layout(args.layout, args.max_records_per_file, args.sort_by_time) if loads else None
    spark = build_session("farebox", args.master)
    store = jobs.Store(args.table, args.ledger, args.summary, args.quarantine)
    table = TripTable(spark, store.table)
    match args.command:
        case "create":
            table.create()
        case "load":
            _report(jobs.monthly_load(spark, args.raw, store, args.year, args.months, layout))
        case "backfill":
            _report(jobs.backfill(spark, args.raw, store, args.first, args.last, layout))
        case "scheduled":
            _report(jobs.scheduled_load(spark, args.raw, store, args.run_date, args.lag, layout))
        case "watch":
            from .streaming.pickup import pick_up_months

            pick_up_months(spark, args.raw, store, args.checkpoint, layout).awaitTermination()
        case "delete":
            for month in jobs.delete_months(spark, store, month_span(args.first, args.last)):
                print(f"{month:%Y-%m}  deleted")
        case "export":
            months = month_span(args.first, args.last or args.first) if args.first else None
            trips = table.read(months).select(*TABLE_COLUMNS)
            parts = arrow_sink.export_partitions(trips, args.folder)
            print(f"{sum(p.rows for p in parts):,} rows in {len(parts)} files")
        case "rejected":
            if not args.quarantine:
                parser.error("rejected needs --quarantine")
            kept = read_quarantine(spark, args.quarantine)
            _print_rows(violation_counts(kept, MONTH_COLUMN).orderBy(MONTH_COLUMN, "broken"))
        case "quality":
            rows = jobs.require_table_quality(spark, store, parse_month(args.month))
            print(f"passed: {rows:,} rows, no fare out of range")
        case "health":
            report = jobs.table_health(spark, store, utc_now()).collect()
            for check in report:
                print(f"[{'PASS' if check.passed else 'FAIL'}] {check.check_name}: {check.value}")
            failed = sum(not check.passed for check in report)
            print("all passed" if not failed else f"{failed} failed")
            return 1 if failed else 0
        case "sql":
            register_views(
                spark, table.read(),
                jobs.read_summary(table, store.summary) if store.summary else None,
            )
            RunLedger(spark, store.ledger).read().createOrReplaceTempView(LEDGER_TABLE)
            answer = spark.sql(args.text)
            if args.limit is not None:
                answer = answer.limit(args.limit)
            if args.out:
                answer.write.parquet(args.out)
            else:
                _print_rows(answer)
    return 0


if __name__ == "__main__":
    sys.exit(main())
