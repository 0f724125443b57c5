"""Command line: ``spark-submit`` or ``python -m tidemark <job> …``."""

import argparse
import json
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.anomaly import anomaly_report
from tidemark.operators.daily import daily_user_metrics
from tidemark.operators.features import feature_usage
from tidemark.operators.funnel import funnel_metrics
from tidemark.operators.retention import retention_cohorts
from tidemark.operators.revenue import revenue_metrics
from tidemark.plans import jobs
from tidemark.schema import ANOMALY_THRESHOLD, ANOMALY_WINDOW
from tidemark.session import get_spark
from tidemark.sources.lake import create_gold_tables, read_silver, write_gold
from tidemark.streaming import landing, merging

# job -> (builder, order of the printed sample, rows printed)
TABLES = {
    "daily": (daily_user_metrics, ("event_date",), 10),
    "retention": (retention_cohorts, ("signup_date", "retention_day"), 20),
    "funnel": (funnel_metrics, ("event_date", "step_order"), 25),
    "features": (feature_usage, ("event_date", "-event_count"), 15),
    "revenue": (revenue_metrics, ("event_date",), 15),
}


def _sample(table: DataFrame, order: tuple[str, ...], rows: int) -> None:
    columns = [table[c[1:]].desc() if c.startswith("-") else table[c].asc() for c in order]
    table.orderBy(*columns).show(rows, truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, *required: str, help: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    clean = command("clean", "input", "output", help="bronze to silver, all or a date range")
    clean.add_argument("--start-date")
    clean.add_argument("--end-date")
    for name in TABLES:
        command(name, "input", "output", help=f"silver to the {name} metric table")
    anomaly = command("anomaly", "daily-metrics", "revenue-metrics", "output", help="anomalies of daily metrics")
    anomaly.add_argument("--window", type=int, default=ANOMALY_WINDOW)
    anomaly.add_argument("--threshold", type=float, default=ANOMALY_THRESHOLD)
    check = command("check", "silver-path", help="data-quality checks")
    check.add_argument("--subset", choices=("all", "schema", "freshness"), default="all")
    check.add_argument("--block", action="store_true", help="fail the run if any check fails")
    command("run", "input", "silver-path", "gold-root", help="clean, check, roll up and rebuild every metric table")
    command("gold", "silver-path", "gold-root", help="roll up and rebuild every metric table from silver")
    backfill = command(
        "backfill", "input", "silver-path", "gold-root", "start-date", "end-date", help="redo a date range end to end"
    )
    backfill.add_argument("--warn", action="store_true", help="go on to gold even if a quality check fails")
    backfill.add_argument("--zones", action="store_true", help="read only bronze directories that hold events of the range, by a zone map")
    register = command("register", "gold-root", help="external tables over the metric tables in the session's catalog")
    register.add_argument("--database", help="made if it is not there")
    land = command("land", "input", "output", "checkpoint", help="stream arriving events into bronze")
    land.add_argument("--quarantine")
    land.add_argument("--with-rejected", action="store_true", help="one query for both outcomes, in folders under the output")
    land.add_argument("--max-files-per-trigger", type=int)
    land.add_argument("--once", action="store_true", help="stop when caught up")
    stream = command("stream", "input", "output", "checkpoint", help="stream bronze into batches of clean events, late ones on a side")
    stream.add_argument("--lateness-minutes", type=int, default=int(merging.LATENESS.total_seconds() // 60))
    stream.add_argument("--max-files-per-trigger", type=int)
    stream.add_argument("--once", action="store_true", help="stop when caught up")
    command("merge", "input", "silver-path", "gold-root", help="merge streamed batches into silver, refresh the metric tables")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "clean" and (args.start_date or args.end_date):
        print(json.dumps(jobs.backfill_silver(spark, args.input, args.output, args.start_date, args.end_date).report))
    elif args.job == "clean":
        print(json.dumps(jobs.clean_bronze(spark, args.input, args.output)))
    elif args.job in TABLES:
        build, order, rows = TABLES[args.job]
        write_gold(build(read_silver(spark, args.input)), args.output)
        _sample(spark.read.parquet(args.output), order, rows)
    elif args.job == "anomaly":
        daily, revenue = spark.read.parquet(args.daily_metrics), spark.read.parquet(args.revenue_metrics)
        write_gold(anomaly_report(daily, revenue, args.window, args.threshold), args.output)
        written = spark.read.parquet(args.output)
        _sample(written, ("event_date", "metric_name"), 30)
        print(f"Anomalies flagged: {written.filter('is_anomaly').count()} / {written.count()} rows")
    elif args.job == "check":
        mode = "raise" if args.block else "warn"
        result = jobs.check_silver(spark, args.silver_path, args.subset, mode)
        print(json.dumps({"checks": result.checks, "summary": result.summary, "run_at": result.run_at}, indent=2))
    elif args.job == "run":
        report, checks = jobs.run_daily(spark, args.input, args.silver_path, args.gold_root)
        print(json.dumps({**report, "quality": checks.summary}))
    elif args.job == "gold":
        jobs.rebuild_gold(spark, args.silver_path, args.gold_root)
    elif args.job == "backfill":
        paths = (args.input, args.silver_path, args.gold_root)
        mode = "warn" if args.warn else "raise"
        print(json.dumps(jobs.run_backfill(spark, *paths, args.start_date, args.end_date, mode=mode, zones=args.zones)))
    elif args.job == "register":
        create_gold_tables(spark, args.gold_root, args.database)
    elif args.job == "stream":
        trigger = landing.UNTIL_CAUGHT_UP if args.once else landing.EVERY_FLUSH
        arriving = landing.read_event_stream(spark, args.input, args.max_files_per_trigger)
        lateness = timedelta(minutes=args.lateness_minutes)
        landing.await_all(spark, [merging.stream_batches(arriving, args.output, args.checkpoint, lateness, trigger=trigger)])
    elif args.job == "merge":
        touched = jobs.run_merge(spark, lambda: merging.merge_stream(spark, args.input, args.silver_path), args.silver_path, args.gold_root)
        print(json.dumps({"dates": sorted(d.isoformat() for d in touched)}))
    elif args.job == "land" and args.with_rejected:
        trigger = landing.UNTIL_CAUGHT_UP if args.once else landing.EVERY_FLUSH
        arriving = landing.read_event_stream(spark, args.input, args.max_files_per_trigger)
        landing.await_all(spark, [landing.land_both(arriving, args.output, args.checkpoint, trigger=trigger)])
    elif args.job == "land":
        trigger = landing.UNTIL_CAUGHT_UP if args.once else landing.EVERY_FLUSH
        arriving = landing.read_event_stream(spark, args.input, args.max_files_per_trigger)
        queries = [landing.land_events(arriving, args.output, f"{args.checkpoint}/accepted", trigger=trigger)]
        if args.quarantine:
            rejected = landing.quarantine_events(arriving, args.quarantine, f"{args.checkpoint}/rejected", trigger=trigger)
            queries.append(rejected)
        landing.await_all(spark, queries)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = get_spark(f"tidemark {args.job}")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
