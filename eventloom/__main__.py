"""Command line of the daily jobs.

    python -m eventloom extract IN_ROOT FACTS_ROOT 2024-01-01 [--until DAY] [--facts repos commits]
    python -m eventloom metrics FACTS_ROOT OUT_ROOT 2024-01-31 [--from DAY] [--to DAY] [--only NAME ...] [--limit N] [--kept]
    python -m eventloom missing IN_ROOT 2024-01-01 [--until DAY]
    python -m eventloom compact FACTS_ROOT 2024-01-31 [--file-size 128MB]
    python -m eventloom advance FACTS_ROOT [--sets NAME ...]
    python -m eventloom landed IN_ROOT INDEX_ROOT 2024-01-01 [--until DAY]
    python -m eventloom sql FACTS_ROOT "SELECT * FROM commits_gt1(DATE'2024-01-01', DATE'2024-01-31') LIMIT 20"
    python -m eventloom follow IN_ROOT FACTS_ROOT [--checkpoint DIR] [--clean delete] [--afresh]
    python -m eventloom live IN_ROOT OUT_ROOT [--late "1 hour"]

On a cluster: ``spark-submit --py-files eventloom.zip eventloom/__main__.py ...``.
"""

from __future__ import annotations

import argparse

from eventloom.plans.compact import FILE_SIZE, compact
from eventloom.plans.daily import METRICS, STATISTICS, run_days, run_metrics
from eventloom.schemas import FACTS, input_schema
from eventloom.plans.incremental import SETS, advance
from eventloom.plans.sql import register
from eventloom.session import get_session
from eventloom.sources.landed import hours_landed, index_files
from eventloom.sources.raw import missing_files, stream_activity
from eventloom.streaming.live import LIVE, run_live, stream_facts

# Hourly files taken up by one stream batch: a week's, so a backlog is not one batch.
_FILES_AT_ONCE = 168


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="eventloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    extract = jobs.add_parser("extract", help="build facts of a day or of a range of days")
    extract.add_argument("in_root")
    extract.add_argument("facts_root")
    extract.add_argument("day")
    extract.add_argument("--until", help="last day of a range")
    extract.add_argument("--facts", nargs="+", choices=list(FACTS), default=list(FACTS))

    extract.add_argument("--clean", choices=["off", "delete"], default="off", help="what to do with the files afterwards")

    missing = jobs.add_parser("missing", help="list hourly files of the days that have not landed")
    missing.add_argument("in_root")
    missing.add_argument("day")
    missing.add_argument("--until", help="last day of a range")

    metrics = jobs.add_parser("metrics", help="export metrics as CSV")
    metrics.add_argument("facts_root")
    metrics.add_argument("out_root")
    metrics.add_argument("run_date")
    metrics.add_argument("--from", dest="date_from")
    metrics.add_argument("--to", dest="date_to")
    metrics.add_argument("--only", nargs="+", choices=[*METRICS, *STATISTICS], default=list(METRICS))
    metrics.add_argument("--limit", type=int, default=0, help="first rows of each; 0 for all")

    metrics.add_argument("--kept", action="store_true", help="read what sets kept day by day answer from these")

    kept = jobs.add_parser("advance", help="bring sets kept day by day up to the stored facts")
    kept.add_argument("facts_root")
    kept.add_argument("--sets", nargs="+", choices=list(SETS), default=list(SETS))

    landed = jobs.add_parser("landed", help="index hourly files and list those that are missing, empty or cut off")
    landed.add_argument("in_root")
    landed.add_argument("index_root")
    landed.add_argument("day")
    landed.add_argument("--until", help="last day of a range")

    packed = jobs.add_parser("compact", help="bring the batches of closed days together in few files")
    packed.add_argument("facts_root")
    packed.add_argument("before", help="the first day that is left alone")
    packed.add_argument("--facts", nargs="+", choices=list(FACTS), default=list(FACTS))
    packed.add_argument("--file-size", default=FILE_SIZE)

    ask = jobs.add_parser("sql", help="show the rows of a SQL text over the facts and their metric functions")
    ask.add_argument("facts_root")
    ask.add_argument("text")
    ask.add_argument("--rows", type=int, default=100, help="rows shown at most")

    follow = jobs.add_parser("follow", help="append facts from newly landed files")
    follow.add_argument("in_root")
    follow.add_argument("facts_root")
    follow.add_argument("--checkpoint", help="used if the session names no spark.checkpoint.dir")
    follow.add_argument("--clean", choices=["off", "delete"], default="off")
    follow.add_argument("--facts", nargs="+", choices=list(FACTS), default=list(FACTS))
    follow.add_argument("--files-at-once", type=int, default=_FILES_AT_ONCE)
    follow.add_argument("--afresh", action="store_true", help="start without progress: the files read before are gone")

    live = jobs.add_parser("live", help="add newly landed files to the counts per hour")
    live.add_argument("in_root")
    live.add_argument("out_root")
    live.add_argument("--checkpoint", help="used if the session names no spark.checkpoint.dir")
    live.add_argument("--late", default="1 hour", help="how late an event may come before it is reported")
    live.add_argument("--only", nargs="+", choices=list(LIVE), default=list(LIVE))
    live.add_argument("--files-at-once", type=int, default=_FILES_AT_ONCE)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = get_session(f"eventloom {args.job}")
    if args.job == "extract":
        summary = run_days(
            spark, args.in_root, args.facts_root, args.day, args.until or args.day, args.facts, args.clean == "delete"
        )
        print(f"{summary.rows_in} events, {summary.rejected} rejected")
        for fact, rows in summary.rows_out.items():
            ratio = summary.ratio(fact)
            print(f"{fact}: {rows} rows" + (f", ratio {ratio:.2f}" if ratio else ""))
    elif args.job == "metrics":
        for target in run_metrics(
            spark, args.facts_root, args.out_root, args.run_date, args.date_from, args.date_to, args.only, args.limit, args.kept
        ):
            print(target)
    elif args.job == "missing":
        for row in missing_files(spark, args.in_root, args.day, args.until).toLocalIterator():
            print(row.file_name)
    elif args.job == "advance":
        for name, days in advance(spark, args.facts_root, args.sets).items():
            print(f"{name}: {days} days changed")
    elif args.job == "landed":
        index_files(spark, args.in_root, args.index_root, args.day, args.until)
        hours = hours_landed(spark, args.in_root, args.index_root, args.day, args.until).where("state <> 'complete'")
        for row in hours.toLocalIterator():
            print(f"{row.file_name}: {row.state}")
    elif args.job == "compact":
        for fact, batches in compact(spark, args.facts_root, args.before, args.facts, args.file_size).items():
            print(f"{fact}: {batches} batches brought together")
    elif args.job == "sql":
        register(spark, args.facts_root)
        spark.sql(args.text).show(args.rows, truncate=False)
    elif args.job == "live":
        activity = stream_activity(spark, args.in_root, args.files_at_once)
        for name, groups in run_live(activity, args.out_root, args.checkpoint, args.late, args.only).items():
            print(f"{name}: {groups} groups came too late for hours complete before, and were added")
    else:
        activity = stream_activity(
            spark, args.in_root, args.files_at_once, clean_source=args.clean, schema=input_schema(args.facts)
        )
        stream_facts(
            activity, args.facts_root, args.checkpoint, args.facts, afresh=args.afresh
        ).awaitTermination()


if __name__ == "__main__":
    main()
