"""Command line for schedulers: ``spark-submit`` (or ``python -m roasty``)
with one action of the chain.

    python -m roasty daily    --layout layout.json [--as-of 2024-01-31] --days-back 1 [--late widen]
    python -m roasty backfill --layout layout.json --first 2024-01-01 --last 2024-01-21
    python -m roasty lookback --layout layout.json [--as-of 2024-01-31] --lookback-days 7
    python -m roasty jobs     --layout layout.json --jobs jobs.json --job-action daily [--as-of ...] --days-back 1
    python -m roasty checks   --validation validation.json --tables tables.json --out flags/ [--group kpis]
    python -m roasty logs     --log-config logs.json --logs path/to/log --job-type daily --out flags/
    python -m roasty plan     --flags flags/ --out plan/ [--as-of ...]

``tables.json`` maps ``"dataset.table"`` to a Parquet path. ``checks`` and
``logs`` write their flagged rows as JSON records (``logs`` without the
``--days-back`` of each command); ``plan`` turns such flags into the
commands to rerun, one per job and missed day.

``layout.json`` holds the ``Layout`` fields (``landing_root``, ``raw_root``,
``fact_path``, ``panel_path``; optional ``landing_template``, ``by_install``)
and optionally ``log_path``, the job-log table each run appends to. The
as-of day defaults to today (UTC); every operator below takes it as an
argument.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from roasty.operators.joblog import JobLogger
from roasty.plans import daily


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def parse(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="roasty")
    sub = p.add_subparsers(dest="action", required=True)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    c = sub.add_parser("checks")
    c.add_argument("--validation", required=True)
    c.add_argument("--tables", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--group")
    c.add_argument("--as-of", type=_date, default=now.date())
    c.add_argument("--as-of-ts", type=dt.datetime.fromisoformat, default=now)
    c.add_argument("--log-path")
    g = sub.add_parser("logs")
    g.add_argument("--log-config", required=True)
    g.add_argument("--logs", required=True)
    g.add_argument("--job-type", default="daily")
    g.add_argument("--out", required=True)
    g.add_argument("--missing", choices=["ignore", "flag"], default="ignore")
    g.add_argument("--as-of-ts", type=dt.datetime.fromisoformat, default=now)
    g.add_argument("--log-path")
    pl = sub.add_parser("plan")
    pl.add_argument("--flags", required=True)
    pl.add_argument("--out", required=True)
    pl.add_argument("--as-of", type=_date, default=now.date())
    pl.add_argument("--log-path")
    for name in ("daily", "backfill", "lookback", "jobs"):
        a = sub.add_parser(name)
        a.add_argument("--layout", required=True)
        a.add_argument("--as-of", type=_date, default=now.date())
        if name in ("daily", "jobs"):
            a.add_argument("--days-back", type=int, default=1)
        if name in ("daily", "backfill"):
            a.add_argument("--late", choices=["widen", "drop", "reject"], default="widen")
        if name == "backfill":
            a.add_argument("--first", type=_date, required=True)
            a.add_argument("--last", type=_date, required=True)
        if name == "lookback":
            a.add_argument("--lookback-days", type=int, default=7)
        if name == "jobs":
            a.add_argument("--jobs", required=True)
            a.add_argument("--job-action", default="daily")
    return p.parse_args(argv)


def _command(argv: list[str]) -> str:
    """The command line as logged: without ``--as-of``, so that a rerun with
    ``--days-back N`` (a backfill plan's command) counts from the day it runs."""
    out, skip = [], False
    for a in argv:
        if skip:
            skip = False
        elif a == "--as-of":
            skip = True
        elif not a.startswith("--as-of="):
            out.append(a)
    return " ".join(["python -m roasty"] + out)


def _session(spark, action: str):
    if spark is not None:
        return spark
    from pyspark.sql import SparkSession

    from roasty.session import apply_defaults

    return apply_defaults(SparkSession.builder.appName(f"roasty-{action}").getOrCreate())


def monitor(args: argparse.Namespace, spark, argv: list[str] | None = None) -> int:
    """The ``checks``, ``logs`` and ``plan`` actions, logged to
    ``--log-path`` when given."""
    spark = _session(spark, args.action)
    logger = (
        JobLogger(spark, args.log_path, args.action, "daily", "roasty", message=_command(sys.argv[1:] if argv is None else argv))
        if args.log_path
        else None
    )
    if logger:
        logger.log("start")
    try:
        _monitor(args, spark)
    except Exception:
        if logger:
            logger.log("error")
        raise
    if logger:
        logger.log("end")
    return 0


def _monitor(args: argparse.Namespace, spark) -> None:
    from pyspark.sql import functions as F

    from roasty.operators import joblog
    from roasty.plans import monitoring
    from roasty.schemas import JOB_LOG

    if args.action == "checks":
        with open(args.validation) as fh:
            config = json.load(fh)
        with open(args.tables) as fh:
            paths = json.load(fh)
        flags = monitoring.run_validation(
            config, lambda d, t: spark.read.parquet(paths[f"{d}.{t}"]), args.as_of, args.as_of_ts, args.group
        )
        joblog.write_flags(flags, args.out)
    elif args.action == "logs":
        with open(args.log_config) as fh:
            config = json.load(fh)
        logs = spark.read.schema(JOB_LOG).parquet(args.logs)
        exp = monitoring.log_alerts_from_config(spark, config, args.job_type)
        stale = joblog.log_staleness(logs, exp, args.as_of_ts, args.missing)
        joblog.write_flags(joblog.flags_for_retry(stale), args.out)
    else:
        flags = spark.read.schema(
            "job_name string, job_type string, file_name string, message string, dt string"
        ).json(args.flags)
        plan = joblog.backfill_plan(flags.where(F.col("job_name").isNotNull()), args.as_of)
        plan.write.mode("overwrite").json(args.out)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse(sys.argv[1:] if argv is None else argv)
    if args.action in ("checks", "logs", "plan"):
        return monitor(args, spark, argv)
    with open(args.layout) as fh:
        conf = json.load(fh)
    log_path = conf.pop("log_path", None)
    layout = daily.Layout(**conf)
    spark = _session(spark, args.action)
    message = _command(sys.argv[1:] if argv is None else list(argv))

    job_type = args.job_action if args.action == "jobs" else args.action

    def logger(job: str):
        return JobLogger(spark, log_path, job, job_type, "roasty", message=message) if log_path else None

    if args.action == "daily":
        daily.run_daily(spark, layout, args.as_of, args.days_back, logger("chain"), args.late)
    elif args.action == "backfill":
        daily.backfill(spark, layout, args.first, args.last, logger("chain"), args.late)
    elif args.action == "lookback":
        daily.run_lookback(spark, layout, args.as_of, args.lookback_days, logger("chain"))
    else:
        with open(args.jobs) as fh:
            jobs = json.load(fh)
        daily.run_jobs(spark, layout, jobs, args.job_action, args.as_of, args.days_back, logger_for=logger)
    return 0


if __name__ == "__main__":
    sys.exit(main())
