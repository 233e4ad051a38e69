"""Command line of the jobs: ``spark-submit ... wardflow/jobs.py <job>`` or ``python -m wardflow.jobs <job>``."""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from wardflow.operators.model import top_risk
from wardflow.operators.summary import read_daily_summary, resolve_stat_date
from wardflow.plans.daily import run_daily_summary, run_incremental_summary
from wardflow.plans.risk_model import fit_risk_model
from wardflow.plans.risk_refresh import run_risk_refresh
from wardflow.session import get_session
from wardflow.sources import tables
from wardflow.sources.stream import read_vitals_stream
from wardflow.streaming.ingest import compact_batches, compact_vitals, start_vitals_stream


def _pairs(texts: list[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Patient-vitals jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    daily = jobs.add_parser("daily-summary", help="summarise one UTC day of vitals")
    daily.add_argument("--stat-date", default=None, help="YYYY-MM-DD; default: today (UTC)")
    daily.add_argument("--source", required=True, help="vitals table")
    daily.add_argument("--target", required=True, help="summary table")
    daily.add_argument("--format", default="parquet", help="format of the vitals table")

    running = jobs.add_parser("running-summary", help="merge the stream's new batches into the summary state")
    running.add_argument("--root", required=True, help="folder of the stream's tables")
    running.add_argument("--state", required=True, help="table of the summary state")

    stream = jobs.add_parser("ingest", help="read the message stream into the tables")
    stream.add_argument("--root", required=True, help="folder of the tables and the checkpoint")
    stream.add_argument("--format", default="kafka")
    stream.add_argument("--path", default=None, help="folder to watch, for a file format")
    stream.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")
    stream.add_argument("--dedup-delay", default=None, help="drop re-sent readings within this event time")
    stream.add_argument("--available-now", action="store_true", help="stop when the messages at hand are read")

    compact = jobs.add_parser("compact", help="fold ingest batches into the clean vitals table")
    compact.add_argument("--root", required=True)
    compact.add_argument("--batches", action="store_true", help="fold the stream's own small folders instead")
    compact.add_argument("days", nargs="*", metavar="YYYY-MM-DD")

    refresh = jobs.add_parser("risk-refresh", help="recompute risk scores and store the changed ones")
    refresh.add_argument("--profiles", required=True)
    refresh.add_argument("--vitals", required=True)
    refresh.add_argument("--alerts-root", required=True)
    refresh.add_argument("--as-of", default=None, help="UTC time; default: now")

    model = jobs.add_parser("risk-model", help="train the risk model and export the ranking")
    model.add_argument("--profiles", required=True)
    model.add_argument("--vitals", required=True)
    model.add_argument("--output", required=True, help="folder of the CSV ranking")
    model.add_argument("--as-of", default=None, help="UTC time; default: now")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = get_session(f"wardflow-{args.job}")
    now = datetime.now(timezone.utc)
    if args.job == "daily-summary":
        day = resolve_stat_date(args.stat_date, now, strict=True)
        if run_daily_summary(spark, args.source, args.target, day, args.format):
            print(f"Wrote the summary of {day} to {args.target}")
            read_daily_summary(tables.load_daily_summary(spark, args.target), day).show(50, truncate=False)
        else:
            print(f"No vitals for {day}. Nothing written.")
    elif args.job == "running-summary":
        days = run_incremental_summary(spark, f"{args.root}/{tables.VITALS}", args.state)
        print(f"Updated {days} days")
    elif args.job == "ingest":
        envelopes = read_vitals_stream(spark, args.format, _pairs(args.option), path=args.path)
        trigger = {"availableNow": True} if args.available_now else None
        start_vitals_stream(envelopes, args.root, trigger=trigger, dedup_delay=args.dedup_delay).awaitTermination()
    elif args.job == "compact" and args.batches:
        print(compact_batches(spark, args.root))
    elif args.job == "compact":
        compact_vitals(spark, args.root, *args.days)
    elif args.job == "risk-refresh":
        updated = run_risk_refresh(spark, args.profiles, args.vitals, args.alerts_root, args.as_of or now)
        print(f"Updated {updated} profiles")
    else:
        fitted = fit_risk_model(
            tables.load_vitals(spark, args.vitals), tables.load_profiles(spark, args.profiles), args.as_of or now
        )
        fitted.metrics().show()
        top_risk(fitted.ranking()).show(truncate=False)
        tables.export_ranking(fitted.ranking(), args.output)


if __name__ == "__main__":
    main()
