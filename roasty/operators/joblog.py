"""Job log: appending step rows, staleness of the latest run per job, and
the backfill plan that follows from a stale job."""

from __future__ import annotations

import datetime as _dt
import getpass
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from roasty.functions.dates import as_date, hour_boundaries_between
from roasty.functions.strings import strip_days_back
from roasty.operators.incremental import drop_table, restore_table, swap_table
from roasty.schemas import JOB_LOG, LOG_EXPECTATION
from roasty.sources.files import file_table
from roasty.sources.landing import path_exists

# A configuration table is broadcast to every task; it is built from a list
# on the driver, so its size is known before it is used.
MAX_CONFIG_ROWS = 10_000


def config_frame(spark: SparkSession, rows: Sequence, schema) -> DataFrame:
    """A configuration table; up to ``MAX_CONFIG_ROWS`` rows it is marked for
    broadcast, a larger one is joined as Spark sees fit."""
    rows = list(rows)
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= MAX_CONFIG_ROWS else df


# --- K11: append one row per step ----------------------------------------------


#: Steps after which a run goes on: their rows wait for the run's last one.
OPEN_STEPS = frozenset({"start", "success"})


class JobLogger:
    """Job-log rows of one run, a row per step, the step id growing by one;
    the table is partitioned by job type.

    Rows are held until a step that ends the run (``end``, ``error`` and
    whatever else is not ``start`` or ``success``) or ``flush``, and appended
    in one write. Used as a context, the run's rows are written when it ends,
    an exception logged as ``error``."""

    def __init__(self, spark: SparkSession, path: str, job_name: str, job_type: str, file_name: str,
                 message: str = "", log_type: str = "prod", username: str | None = None):
        self.spark, self.path = spark, path
        self.base = {
            "uid": uuid.uuid4().hex[:8],
            "username": username or getpass.getuser(),
            "job_name": job_name,
            "job_type": job_type,
            "file_name": file_name,
            "log_type": log_type,
            "message": message,
        }
        self.step_id = 0
        self.held: list[tuple] = []

    def log(self, step: str, now: _dt.datetime | None = None) -> dict:
        self.step_id += 1
        ts = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        row = dict(self.base, ts=ts, dt=ts.strftime("%Y-%m-%d"), step_name=step, step_id=self.step_id)
        self.held.append(tuple(row[f.name] for f in JOB_LOG.fields))
        if step not in OPEN_STEPS:
            self.flush()
        return row

    def flush(self) -> None:
        """Append the rows held: one small file."""
        if self.held:
            df = self.spark.createDataFrame(self.held, JOB_LOG).coalesce(1)
            df.write.mode("append").partitionBy("job_type").parquet(self.path)
            self.held = []

    def __enter__(self) -> JobLogger:
        return self

    def __exit__(self, kind, *_exc) -> None:
        if kind is not None:
            self.log("error")
        self.flush()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The job log; empty before the first run."""
    restore_table(spark, path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], JOB_LOG)
    return spark.read.schema(JOB_LOG).parquet(path).select(*JOB_LOG.fieldNames())


#: Bytes of log, as stored, that ``compact_log`` puts into one file.
COMPACT_BYTES = 32 << 20


def compact_log(spark: SparkSession, path: str, tries: int = 3) -> int:
    """Rewrite the log's many small files as few per job type, at most one for
    each ``COMPACT_BYTES`` begun, and return the files it has then. The new table
    takes the old one's place by a rename; a run that appended meanwhile makes
    the rewrite start over, so its rows are not lost."""
    for _ in range(tries):
        before = file_table(spark, path).select("path").collect()
        work = f"{path.rstrip('/')}__new_{uuid.uuid4().hex[:8]}"
        _in_few_files(spark, path).write.partitionBy("job_type").parquet(work)
        if set(file_table(spark, path).select("path").collect()) == set(before):
            swap_table(spark, work, path)
            return file_table(spark, path).count()
        drop_table(spark, work)
    raise RuntimeError(f"{path} was appended to during each of {tries} rewrites")


def _in_few_files(spark: SparkSession, path: str) -> DataFrame:
    """The log, dealt out so that a job type comes in no more parts than its
    files have ``COMPACT_BYTES``."""
    log = read_log(spark, path)
    if not path_exists(spark, path):
        return log
    files = spark.read.schema(JOB_LOG).parquet(path).select("job_type", "_metadata.file_path", "_metadata.file_size").distinct()
    parts = files.groupBy(F.col("job_type").alias("_type")).agg(F.ceil(F.sum("file_size") / COMPACT_BYTES).alias("_parts"))
    part = F.pmod(F.xxhash64(*log.columns), F.coalesce("_parts", F.lit(1)))
    dealt = log.join(parts, F.col("job_type").eqNullSafe(F.col("_type")), "left").withColumn("_part", part)
    return dealt.repartition("job_type", "_part").select(*log.columns)


# --- C10: staleness of the latest matching step --------------------------------


def log_expectations(spark: SparkSession, alerts: Sequence[dict]) -> DataFrame:
    """Expectations table from alert configs (keys as in ``LOG_EXPECTATION``;
    ``message`` None or empty means no message filter)."""
    rows = [
        (
            a["alert_name"], a["job_type"], a["job_name"], a["file_name"], a["step_name"],
            a.get("message") or None, int(a["thresh_in_hours"]),
        )
        for a in alerts
    ]
    return config_frame(spark, rows, LOG_EXPECTATION)


def log_staleness(logs: DataFrame, expectations: DataFrame, as_of_ts, missing: str = "ignore",
                  expected: int | None = None) -> DataFrame:
    """Latest log row of every expectation and whether it is older than the
    expectation's threshold in hour boundaries crossed up to ``as_of_ts``.

    All expectations are checked in one pass: the log is joined with the
    broadcast expectations (no shuffle of the log); the newest timestamp per
    expectation is a hash aggregation (partial per partition, so a job with
    most of the rows is no hot spot); the rows at that timestamp are kept by
    a semi join with those maxima (broadcast: one row per expectation) and
    ties on ``ts`` are broken by the other columns, so the answer is
    deterministic.

    ``missing="ignore"`` returns nothing for an expectation without a log
    row; ``missing="flag"`` returns it flagged with NULL log columns.
    """
    # ``expected``, the number of expectations if the caller knows it, also
    # bounds the maxima: one row each. Up to MAX_CONFIG_ROWS they are broadcast.
    few = F.broadcast if expected is not None and expected <= MAX_CONFIG_ROWS else (lambda df: df)
    log_cols = JOB_LOG.fieldNames()
    e = expectations.select(
        "alert_name",
        F.col("job_type").alias("_e_job_type"),
        F.col("job_name").alias("_e_job_name"),
        F.col("file_name").alias("_e_file_name"),
        F.col("step_name").alias("_e_step_name"),
        F.col("message").alias("_e_message"),
        "thresh_in_hours",
    )
    cond = (
        (logs["job_type"] == e["_e_job_type"])
        & (logs["job_name"] == e["_e_job_name"])
        & (logs["file_name"] == e["_e_file_name"])
        & (logs["step_name"] == e["_e_step_name"])
        & (e["_e_message"].isNull() | F.expr("message LIKE _e_message"))
    )
    matched = logs.join(e, cond, "inner")
    # Newest timestamp per expectation: a hash aggregation of one timestamp.
    newest = matched.groupBy(F.col("alert_name").alias("_newest_alert")).agg(F.max("ts").alias("_max_ts"))
    at_newest = matched.join(
        few(newest),
        (F.col("alert_name") == F.col("_newest_alert")) & (F.col("ts") == F.col("_max_ts")),
        "left_semi",
    )
    # Only rows at the newest timestamp remain; ties are broken by the other
    # columns so the answer is deterministic.
    order = ["ts", "step_id", "uid"] + [c for c in log_cols if c not in ("ts", "step_id", "uid")]
    latest = at_newest.groupBy("alert_name", "thresh_in_hours").agg(F.max(F.struct(*order)).alias("_r"))
    if missing != "ignore":
        latest = expectations.select("alert_name", "thresh_in_hours").join(
            few(latest), ["alert_name", "thresh_in_hours"], "left"
        )
    flag = hour_boundaries_between(F.col("_r.ts"), as_of_ts) > F.col("thresh_in_hours")
    if missing != "ignore":
        flag = F.coalesce(flag, F.lit(True))
    return latest.select(
        "alert_name",
        flag.alias("raise_flag"),
        F.date_format("_r.ts", "yyyy-MM-dd").alias("lt"),
        *[F.col(f"_r.{c}").alias(c) for c in log_cols],
    )


# --- K12: flagged rows as JSON records -----------------------------------------------


def flags_for_retry(staleness: DataFrame) -> DataFrame:
    """Flagged rows with ``--days-back N`` removed from the command line."""
    return staleness.where(F.col("raise_flag")).withColumn("message", strip_days_back("message"))


def alert_rows(flags: DataFrame) -> DataFrame:
    """Flagged rows as shown in an alert: every column but the command line."""
    return flags.drop("message")


def write_flags(flags: DataFrame, path: str) -> None:
    """Write flagged rows as JSON lines; an empty folder of records means no
    flag. Readers take the folder, not one file."""
    flags.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path)


def read_flags(spark: SparkSession, path: str) -> DataFrame:
    """Flag records as ``write_flags`` wrote them, with the log's types; an
    empty folder gives no rows."""
    fields = [StructField("alert_name", StringType()), StructField("raise_flag", BooleanType()), StructField("lt", StringType()), *JOB_LOG.fields]
    return spark.read.schema(StructType(fields)).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path)


# --- C12: backfill plan ------------------------------------------------------------------


def backfill_plan(flags: DataFrame, as_of, date_col: str = "dt") -> DataFrame:
    """One row per (flagged job, day) to rerun: every day from the job's
    last run day up to the day before ``as_of``, oldest first. A job whose
    last run is ``as_of`` or later needs nothing. ``command`` is the logged
    command line with ``--days-back`` set for that day.

    Rows grow with flagged jobs times missed days, both small; the day
    sequence is generated per row (explode), not by a join."""
    today = as_date(as_of)
    last = F.to_date(F.col(date_col))
    days = F.when(last < today, F.sequence(last, F.date_sub(today, 1)))
    plan = flags.select(
        "job_name", "job_type", "file_name", strip_days_back("message").alias("base_command"),
        F.explode(days).alias("run_date"),
    )
    back = F.datediff(today, F.col("run_date")).cast("long")
    return plan.select(
        "job_name",
        "job_type",
        "file_name",
        "run_date",
        back.alias("days_back"),
        F.concat(F.col("base_command"), F.lit(" --days-back "), back.cast("string")).alias("command"),
    )


def order_plan(plan: DataFrame) -> DataFrame:
    """The plan in run order: per job, oldest day first."""
    return plan.orderBy("job_name", "run_date")
