"""Data-quality and monitoring checks.

Every check is a DataFrame. The KPI-style checks return the fixed
``CHECK_RESULT`` shape (raise_flag, kpi, dt, metric, previous_metric,
table_name) so results of different checks union; the test-style checks
(audits, stage reconciliation, today's data) return their failing rows,
as a data test does. Nothing is collected: a caller that wants to act on a
flag collects the flagged rows only, which are few by construction.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roasty.functions.dates import as_date, days_back, whole_hours_between
from roasty.functions.strings import is_blank
from roasty.schemas import CHECK_COLUMNS, CHECK_RESULT
from roasty.sources.files import file_table

# Declared column tests of the fact, the panel and each staged feed (fixed
# values: the columns the data tests name).
FACT_NOT_NULL = [
    "dt", "install_time", "event_time", "event_name", "event_source", "media_source",
    "af_channel", "campaign", "country_code", "platform", "app_version", "data_source",
]
FACT_NOT_EMPTY = [
    "event_name", "event_source", "media_source", "af_channel", "campaign",
    "country_code", "platform", "app_version", "data_source",
]
PANEL_NOT_NULL = ["campaign", "dt", "media_source", "t_events", "data_source"]
PANEL_NOT_EMPTY = ["campaign", "media_source", "data_source"]
STAGING_NOT_NULL = [
    "dt", "install_time", "event_time", "event_name", "event_source", "media_source",
    "af_channel", "campaign", "country_code", "platform", "app_version",
]
STAGING_NOT_EMPTY = [
    "event_name", "event_source", "media_source", "af_channel", "campaign",
    "country_code", "platform", "app_version",
]


def check_result(
    raise_flag: Column,
    kpi: Column | str,
    dt: Column,
    metric: Column,
    previous_metric: Column | None,
    table_name: str,
) -> list[Column]:
    """Columns of the common check shape, cast to its declared types."""
    vals = {
        "raise_flag": raise_flag,
        "kpi": F.lit(kpi) if isinstance(kpi, str) else kpi,
        "dt": dt,
        "metric": metric,
        "previous_metric": previous_metric if previous_metric is not None else F.lit(None),
        "table_name": F.lit(table_name),
    }
    return [vals[f.name].cast(f.dataType).alias(f.name) for f in CHECK_RESULT.fields]


# --- C1: row reconciliation of two tables -------------------------------------


def daily_measure(df: DataFrame, key: Column | str, measure: Column) -> DataFrame:
    """``SELECT key AS dt, measure AS cnt FROM df GROUP BY ALL``."""
    k = F.col(key) if isinstance(key, str) else key
    return df.groupBy(k.alias("dt")).agg(measure.cast("long").alias("cnt"))


def reconcile_counts(
    src: DataFrame,
    dst: DataFrame,
    src_key: Column | str,
    dst_key: Column | str,
    cnt_src: Column,
    cnt_dst: Column,
    table_name: str,
    date=None,
    missing: str = "ignore",
    kpi: str = "row_num",
) -> DataFrame:
    """Flag a day whose measure differs between source and destination, or
    whose source measure is 0.

    ``date=None`` checks every day in one job. With ``missing="ignore"``
    (the reference) the sides are inner-joined, so a day missing on one side
    yields nothing; ``missing="flag"`` full-joins and flags such a day.
    Both sides are per-day aggregates, so the join moves one row per day.
    """
    s = daily_measure(src, src_key, cnt_src)
    d = daily_measure(dst, dst_key, cnt_dst)
    if date is not None:
        s = s.where(F.col("dt") == as_date(date))
        d = d.where(F.col("dt") == as_date(date))
    how = "inner" if missing == "ignore" else "full"
    j = d.alias("d").join(s.alias("s"), on="dt", how=how)
    flag = (F.col("s.cnt") != F.col("d.cnt")) | (F.col("s.cnt") == 0)
    if missing != "ignore":
        flag = F.coalesce(flag, F.lit(True))
    return j.select(
        *check_result(flag, kpi, F.col("dt"), F.col("d.cnt"), F.col("s.cnt").cast("string"), table_name)
    )


# --- C2 / C15: four-stage reconciliation ------------------------------------------


def reconcile_stages(
    raw_installs: DataFrame,
    raw_inapp: DataFrame,
    fact: DataFrame,
    panel: DataFrame,
    as_of,
    lookback_days: int = 7,
    landing_key: str | None = "ymd",
) -> DataFrame:
    """Days of the look-back window where raw rows, fact rows and the sum of
    panel events disagree; one row per such day with the three counts.

    The four daily series are unioned and pivoted in one aggregation instead
    of three chained full outer joins: one small shuffle, and a day present
    in any stage appears once."""
    start = days_back(as_of, lookback_days)
    ev_day = F.to_date("event_time")

    def raw_window(raw: DataFrame) -> DataFrame:
        # An event lands on or after its day, so the raw partitions before
        # the window's first day cannot hold a row of the window: the
        # landing-day bound prunes them and changes no count.
        if landing_key and landing_key in raw.columns:
            raw = raw.where(F.col(landing_key) >= F.date_format(start, "yyyyMMdd"))
        return raw.where(ev_day >= start)

    raw_installs, raw_inapp = raw_window(raw_installs), raw_window(raw_inapp)
    parts = [
        raw_installs.groupBy(ev_day.alias("dt")).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit("ext")),
        raw_inapp.groupBy(ev_day.alias("dt")).agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit("ext")),
        fact.where(F.col("dt") >= start).groupBy("dt").agg(F.count(F.lit(1)).alias("n")).withColumn("stage", F.lit("fact")),
        panel.where(F.col("dt") >= start).groupBy("dt").agg(F.sum("t_events").cast("long").alias("n")).withColumn("stage", F.lit("panel")),
    ]
    daily = reduce(DataFrame.unionByName, parts)

    def stage_sum(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stage") == F.lit(name), F.col("n"))), F.lit(0)).cast("long")

    cmp = daily.groupBy("dt").agg(
        stage_sum("ext").alias("ext_rows"),
        stage_sum("fact").alias("fact_rows"),
        stage_sum("panel").alias("daily_panel_rows"),
    )
    return cmp.where(
        (F.abs(F.col("ext_rows") - F.col("fact_rows")) > 0) | (F.abs(F.col("fact_rows") - F.col("daily_panel_rows")) > 0)
    )


# --- C3 / C4: day-over-day change --------------------------------------------------


def change_alert(
    daily: DataFrame,
    date_col: str,
    value_col: str,
    thresh: float,
    kpi: str,
    table_name: str,
    latest_only: bool = True,
) -> DataFrame:
    """Flag a day whose value moved by more than ``thresh`` (a fraction of
    the day's own value) from the previous day.

    ``daily`` is a per-day series (one row per day). With ``latest_only`` the
    two newest days are taken first (a top-2, each partition keeps two rows),
    so the ordered window runs over two rows, not the whole history. A day
    whose value is 0 after a positive previous value is flagged (the
    reference would fail on the division).
    """
    src = daily.select(F.col(date_col).alias("_d"), F.col(value_col).alias("_v"))
    if latest_only:
        src = src.orderBy(F.col("_d").desc()).limit(2)
    # The series has one row per day: ordering it in one partition is
    # bounded by the number of days, not by the rows behind them.
    prev = F.lag("_v").over(Window.orderBy("_d"))
    lagged = src.withColumn("_p", prev)
    change = F.abs(F.try_divide(F.col("_v") - F.col("_p"), F.col("_v")))
    flag = F.col("_p").isNotNull() & F.coalesce(
        change > F.lit(thresh), (F.col("_v") == 0) & (F.col("_p") > 0)
    )
    out = lagged.select(
        *check_result(flag, kpi, F.col("_d"), F.col("_v"), F.col("_p").cast("string"), table_name), F.col("_d")
    )
    if latest_only:
        out = out.orderBy(F.col("_d").desc()).limit(1)
    return out.select(*CHECK_COLUMNS)


# --- C5: inactive users -----------------------------------------------------------------


def inactive_users(
    user_panel: DataFrame,
    as_of,
    days: int = 100,
    kpi: str = "last_active_dt",
    table_name: str = "user_panel",
    user_col: str = "user_id",
    date_col: str = "last_active_dt",
) -> DataFrame:
    """One flagged row per user last active more than ``days`` days before
    ``as_of`` (strictly). A filter and a projection: no shuffle."""
    gap = F.datediff(as_date(as_of), F.col(date_col))
    return user_panel.where(gap > days).select(
        *check_result(
            gap > days,
            F.concat(F.lit(f"{kpi}: "), F.col(user_col).cast("string")),
            as_date(as_of),
            gap,
            F.col(date_col).cast("string"),
            table_name,
        )
    )


# --- C6 / C14: freshness -------------------------------------------------------------------


def freshness(df: DataFrame, ts_col: str, as_of_ts, hours: int, kpi: str, table_name: str) -> DataFrame:
    """One row: whole hours from the newest ``ts_col`` to ``as_of_ts``,
    flagged above ``hours``. A global max: partial maxima per partition,
    one row shuffled each."""
    last = df.agg(F.max(ts_col).alias("_last"))
    age = whole_hours_between("_last", as_of_ts)
    return last.select(
        *check_result(
            # No newest row means an empty table, which is not fresh.
            F.coalesce(age > hours, F.lit(True)),
            f"{kpi} (hours)",
            F.to_date("_last"),
            age,
            F.date_format("_last", "yyyy-MM-dd HH:mm:ss"),
            table_name,
        )
    )


def newest_by_landing(df: DataFrame, ts_col: str, newest_landing: str, landing_key: str = "ymd",
                      fmt: str = "yyyyMMdd") -> DataFrame:
    """``df`` cut to the landing partitions that can hold its newest
    ``ts_col``, exactly, given that every row lands on or after its day.

    ``L``, the newest timestamp of the newest landing partition, is a lower
    bound of the overall newest; that one lands on or after its own day, so
    on or after ``DATE(L)``. Only partitions from ``DATE(L)`` on are read
    (a scalar subquery in a partition filter) instead of the whole table.
    ``newest_landing`` is the newest partition value, from a listing
    (``incremental.partition_values``)."""
    lower = df.where(F.col(landing_key) == F.lit(newest_landing)).agg(F.max(ts_col)).scalar()
    # No row in the newest partition gives no bound: every partition is read.
    bound = F.coalesce(F.date_format(F.to_date(lower), fmt), F.lit(""))
    return df.where(F.col(landing_key) >= bound)


def modified_at(spark: SparkSession, path: str) -> _dt.datetime | None:
    """Newest modification time (UTC) of the files under ``path``; None
    without files. No data is read."""
    return file_table(spark, path).agg(F.max("modified").alias("ts")).first()["ts"]


def freshness_modified(spark: SparkSession, path: str, as_of_ts, hours: int, kpi: str, table_name: str) -> DataFrame:
    """``freshness`` by the newest modification time of a table's files."""
    return freshness(file_table(spark, path), "modified", as_of_ts, hours, kpi, table_name)


def last_modified(df: DataFrame) -> DataFrame:
    """Newest modification time of the files a DataFrame reads, as ``ts`` (a
    ``timestamp_ntz`` in UTC). The files are those of its plan; their times
    come from a listing that Spark spreads over tasks, not from a scan."""
    files = [unquote(f) for f in df.inputFiles()]
    return file_table(df.sparkSession, files).agg(F.max("modified").alias("ts"))


def severity(df: DataFrame, n_col: str, warn_above: int = 0, error_above: int = 0, out: str = "severity") -> DataFrame:
    """``error`` when ``n_col > error_above``, else ``warn`` when
    ``> warn_above``, else ``pass`` (a test's warn_if / error_if). Without a
    number there is nothing that passed: ``error``."""
    n = F.col(n_col)
    return df.withColumn(
        out,
        F.when(n.isNull() | (n > error_above), F.lit("error")).when(n > warn_above, F.lit("warn")).otherwise(F.lit("pass")),
    )


def freshness_severity(df: DataFrame, as_of_ts, warn_hours: int, error_hours: int, ts_col: str, table_name: str) -> DataFrame:
    """Model freshness: age in whole hours and its severity."""
    last = df.agg(F.max(ts_col).alias("last_loaded"))
    aged = last.select(
        F.lit(table_name).alias("table_name"),
        "last_loaded",
        whole_hours_between("last_loaded", as_of_ts).alias("age_hours"),
    )
    return severity(aged, "age_hours", warn_hours, error_hours)


# --- C7 / C8: column audits ------------------------------------------------------------------


def column_audit(
    df: DataFrame,
    table_name: str,
    not_null: Sequence[str] = (),
    not_empty: Sequence[str] = (),
) -> DataFrame:
    """Failing-row counts of every not-null and not-blank test of a table,
    in one scan: all counts are conditional sums of one aggregation, then
    unpivoted to one row per (test, column)."""
    if not not_null and not not_empty:
        raise ValueError("column_audit needs at least one column to test")
    aggs, keys = [], []
    for c in not_null:
        aggs.append(F.count(F.when(F.col(c).isNull(), F.lit(1))).alias(f"nn_{c}"))
        keys.append(("not_null", c, f"nn_{c}"))
    for c in not_empty:
        aggs.append(F.count(F.when(is_blank(c), F.lit(1))).alias(f"ne_{c}"))
        keys.append(("string_not_empty", c, f"ne_{c}"))
    wide = df.agg(*aggs)
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(t).alias("test_name"), F.lit(c).alias("column_name"), F.col(a).alias("failures"))
                for t, c, a in keys
            ]
        )
    ).alias("r")
    return wide.select(rows).select(
        F.lit(table_name).alias("table_name"), "r.test_name", "r.column_name", F.col("r.failures").cast("long").alias("failures")
    )


# --- C9: today's data ---------------------------------------------------------------------------


def has_todays_data(df: DataFrame, as_of, date_column: str = "event_time", table_name: str = "") -> DataFrame:
    """No row when the table has a row dated ``as_of``; otherwise one row
    with the count of rows of other days (``HAVING`` on a global count)."""
    d = F.to_date(F.col(date_column))
    day = as_date(as_of)
    agg = df.agg(
        F.count(F.when(d != day, F.lit(1))).alias("failures"),
        F.count(F.when(d == day, F.lit(1))).alias("_today"),
    )
    return agg.where(F.col("_today") == 0).select(
        F.lit(table_name).alias("table_name"), day.alias("as_of"), "failures"
    )


# --- C11: run a set of checks ----------------------------------------------------------------


def run_checks(checks: Mapping[str, DataFrame], enabled: Iterable[str] | None = None, flagged_only: bool = True) -> DataFrame:
    """Union of the enabled checks (all by default), flagged rows only."""
    names = [n for n in checks if enabled is None or n in set(enabled)]
    if not names:
        raise ValueError("no enabled check")
    allc = reduce(DataFrame.unionByName, [checks[n].select(*CHECK_COLUMNS) for n in names])
    return allc.where(F.col("raise_flag")) if flagged_only else allc


def any_flag(results: DataFrame) -> bool:
    """Is any check flagged? Stops at the first flagged row."""
    return not results.where(F.col("raise_flag")).isEmpty()


__all__ = [
    "check_result",
    "reconcile_counts",
    "reconcile_stages",
    "change_alert",
    "inactive_users",
    "freshness",
    "newest_by_landing",
    "last_modified",
    "severity",
    "freshness_severity",
    "column_audit",
    "has_todays_data",
    "run_checks",
    "any_flag",
]
