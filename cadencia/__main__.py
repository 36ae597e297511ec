"""Command line: ``spark-submit ... -m cadencia <job>`` or ``python -m cadencia <job>``.

Any failure ends with a non-zero exit code; ``audit`` returns its verdict.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date, datetime
from pathlib import Path

from cadencia.functions import calendar, clock
from cadencia.plans import jobs
from cadencia.plans.audit import Pair, audit
from cadencia.plans.store import rebuild_table
from cadencia.session import build_session


def _pair(text: str) -> Pair:
    name, left, right = text.split("=")[0], *text.split("=")[1].split(",")
    return Pair(name, left, right)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cadencia")
    job = parser.add_subparsers(dest="job", required=True)

    trips = job.add_parser("trips", help="weekly trips: land, replace both histories, rebuild gaps")
    trips.add_argument("raw")
    for table in ("trips", "headways", "gaps"):
        trips.add_argument(f"--{table}", required=True, metavar="TABLE")
    trips.add_argument("--landing", required=True)
    trips.add_argument("--start", type=datetime.fromisoformat, help="default: last closed service week")
    trips.add_argument("--end", type=datetime.fromisoformat)
    trips.add_argument("--keep-outliers", action="store_true")
    trips.add_argument("--stray", choices=("reject", "keep"), default="keep")
    trips.add_argument("--no-line-breaks", action="store_true", help="no quoted value holds one: files can be split")
    trips.add_argument("--out", help="folder for the processed CSV, named after the raw file")

    can = job.add_parser("can", help="telemetry of one day or a range of days")
    can.add_argument("folder")
    can.add_argument("out")
    can.add_argument("--first", type=date.fromisoformat, default=None, help="default: today")
    can.add_argument("--last", type=date.fromisoformat, default=None)
    can.add_argument("--format", action="append", help="stamp format, repeatable")
    can.add_argument("--no-line-breaks", action="store_true")
    can.add_argument("--unreadable", choices=("fail", "null"), default="fail", help="stamps in no format")

    fleet = job.add_parser("fleet", help="fleet snapshot")
    fleet.add_argument("path")
    fleet.add_argument("--table")

    stamp = job.add_parser("stamp", help="add date and shift to a schedule extract")
    stamp.add_argument("path")
    stamp.add_argument("out")
    stamp.add_argument("--at", type=datetime.fromisoformat, help="default: now")

    land = job.add_parser("land", help="keep a report unchanged")
    land.add_argument("report")
    land.add_argument("paths", nargs="+")
    land.add_argument("--window-start", type=date.fromisoformat, help="default: the report's own week or day")
    land.add_argument("--no-line-breaks", action="store_true")
    land.add_argument("--landing", required=True)
    land.add_argument("--expected", help="land one file of the folder given: the one of this name")
    land.add_argument("--pattern", help="or else the newest whose name fits this pattern")

    rebuild = job.add_parser("rebuild", help="create or replace a table from a query file")
    rebuild.add_argument("source")
    rebuild.add_argument("dest")
    rebuild.add_argument("--sql", type=Path, help="default: scheduled gaps")
    rebuild.add_argument("--min-row-ratio", type=float, default=0.9)

    compare = job.add_parser("audit", help="compare pairs of tables as multisets")
    compare.add_argument("pairs", nargs="+", type=_pair, metavar="NAME=LEFT,RIGHT")
    compare.add_argument("--cutoff", required=True)
    compare.add_argument("--until")
    compare.add_argument("--out-dir")
    compare.add_argument("--dump-limit", type=int, default=None, help="default: all rows")
    return parser


def main(argv: Sequence[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(f"cadencia-{args.job}")
    if args.job == "trips":
        start, end = calendar.last_service_week()
        tables = jobs.TripTables(args.trips, args.headways, args.gaps)
        written = jobs.run_trips(
            spark, args.raw, args.start or start, args.end or end, tables, args.landing,
            remove_outliers=not args.keep_outliers, stray=args.stray, line_breaks=not args.no_line_breaks,
            out_root=args.out,
        )
        print(*(f"{table}: {n} rows" for table, n in written.items()), sep="\n")
    elif args.job == "can":
        first = args.first or calendar.today()
        summary, skipped = jobs.run_can(
            spark, args.folder, first, args.last or first, args.out, args.format or clock.STAMP_FORMATS,
            line_breaks=not args.no_line_breaks, unreadable=args.unreadable,
        )
        # One row per requested day and configured brand.
        for row in summary.orderBy("report_day", "brand").collect():
            print(f"{row.report_day} {row.brand}: {row.n_rows} rows")
        print("skipped:", ", ".join(map(str, skipped)) or "none")
    elif args.job == "fleet":
        snapshot = jobs.run_fleet(spark, args.path, args.table)
        print("no snapshot" if snapshot is None else f"{snapshot.count()} rows")
    elif args.job == "stamp":
        print(jobs.run_stamp(spark, args.path, args.out, args.at), "rows")
    elif args.job == "land":
        fresh = jobs.run_landing(
            spark, args.paths, args.report, args.window_start or jobs.default_window_start(args.report), args.landing,
            line_breaks=not args.no_line_breaks, expected=args.expected, pattern=args.pattern,
        )
        print("landed:", ", ".join(fresh) or "nothing new")
    elif args.job == "rebuild":
        sql = args.sql.read_text("utf-8") if args.sql else jobs.SCHEDULED_GAPS_SQL
        print(rebuild_table(spark, sql, args.source, args.dest, args.min_row_ratio), "rows")
    else:
        code, reports = audit(
            spark, args.pairs, args.cutoff, until=args.until, out_dir=args.out_dir, dump_limit=args.dump_limit
        )
        for report in reports:
            print(report.name, report.code, report.summary, *report.messages, report.dump or "")
        return code
    return 0


if __name__ == "__main__":
    sys.exit(main())
