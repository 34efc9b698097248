"""Command line: one subcommand per job of the original pipeline.

    python -m turnstile land-students --root LAKE --csv students.csv
    python -m turnstile produce       --root LAKE --events events.json [--lines] [--kafka host:port]
    python -m turnstile stream        --root LAKE [--kafka host:port] [--max-offsets N] [--upsert] [--rejects] [--copies-within "1 hour"]
    python -m turnstile full          --root LAKE [--as-of "2026-03-10 00:00:00"] [--show] [--publish DATABASE]
    python -m turnstile compact       --root LAKE --day 2026-03-05
    python -m turnstile daily         --root LAKE [--show] [--day 2026-03-05]
    python -m turnstile increment     --root LAKE [--as-of ...] [--max-files N]
    python -m turnstile analytics     --root LAKE [--as-of ...] [--days 30] [--show]

On a cluster run it through spark-submit; the session takes the cluster's settings.
"""

from __future__ import annotations

import argparse
import datetime as dt

from turnstile.config import Settings
from turnstile.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="turnstile")
    p.add_argument("command", choices=["land-students", "produce", "stream", "full", "daily", "increment", "compact", "analytics"])
    p.add_argument("--root", required=True, help="folder (shared storage) holding every table")
    p.add_argument("--csv", help="student file for land-students")
    p.add_argument("--events", help="JSON-array event file for produce")
    p.add_argument("--kafka", default="localhost:9092", help="bootstrap servers")
    p.add_argument("--as-of", default=None, help="cut-off time (default: now)")
    p.add_argument("--days", type=int, default=30, help="trailing days for the period question")
    p.add_argument("--show", action="store_true", help="print the first rows of each output")
    p.add_argument("--lines", action="store_true", help="produce: the event file is JSON Lines")
    p.add_argument("--max-offsets", type=int, default=1_000_000, help="stream: offsets a micro-batch takes at most")
    p.add_argument("--upsert", action="store_true", help="stream: also keep the graph's event tables up to date")
    p.add_argument(
        "--day", type=dt.date.fromisoformat, default=None,
        help="daily: the day to run (again), instead of the latest; compact: the first day that stays as it is (default: today)",
    )
    p.add_argument("--rejects", action="store_true", help="stream: also keep the payloads that give no event")
    p.add_argument("--copies-within", default=None, help='stream: leave out copies that arrive within, for example, "1 hour"')
    p.add_argument("--publish", default=None, help="full: run in a new folder, then point the views of this database to it")
    p.add_argument("--max-files", type=int, default=None, help="increment: curated files that a micro-batch takes at most")
    p.add_argument("--master", default=None)
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(app_name=f"turnstile-{args.command}", master=args.master)
    settings = Settings(
        root=args.root, kafka_servers=args.kafka, students_csv=args.csv, max_offsets_per_trigger=args.max_offsets
    )
    from turnstile.plans import jobs

    if args.command == "land-students":
        jobs.land_students(spark, settings)
    elif args.command == "produce":
        from turnstile.operators.ingest import route_events
        from turnstile.sinks import write_kafka
        from turnstile.sources import read_events_json

        write_kafka(route_events(read_events_json(spark, args.events, lines=args.lines)), settings.kafka_servers)
    elif args.command == "stream":
        from turnstile.streaming import run_stream

        run_stream(spark, settings, upsert=args.upsert, rejects=args.rejects, copies_within=args.copies_within)
    elif args.command == "full" and args.publish:
        from turnstile.plans.versions import run_versioned

        run_versioned(spark, settings, args.publish, as_of=args.as_of)
    elif args.command == "compact":
        from turnstile.plans.compaction import compact

        compact(spark, settings, args.day or dt.datetime.now(dt.timezone.utc).date())
    elif args.command == "full":
        jobs.run_full_batch(spark, settings, as_of=args.as_of, show=args.show)
    elif args.command == "daily":
        jobs.run_daily_batch(spark, settings, show=args.show, day=args.day)
    elif args.command == "increment":
        from turnstile.plans.increments import run_increment

        run_increment(spark, settings, as_of=args.as_of, max_files=args.max_files)
    elif args.command == "analytics":
        jobs.run_analytics(spark, settings, args.as_of, args.days, show=args.show)


if __name__ == "__main__":
    main()
