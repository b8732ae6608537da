"""Upstream KPI panels kept per landing day and merged exactly: daily active
users, installs per day, last active day per user.

Each panel is stored by landing day in a form that adds up, so a refresh reads
the landing days that changed and nothing else, and late rows simply bring
another partial result for an old day. Distinct users are kept as bitmaps, by
buckets of ids: their union is exact, whatever days they come from.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roasty.operators.incremental import commit_keys

#: The partition key of the stored panels.
LANDING_KEY = "ymd"


def activity_partials(events: DataFrame, day, user_col: str = "user_id") -> DataFrame:
    """``ymd, dt, bucket, users``: which users were seen, a bitmap per bucket
    of 32,768 ids. ``user_col`` is a whole number, best a dense one; a row
    without a user counts for none."""
    user = F.col(user_col).cast("long")
    return (
        events.where(user.isNotNull())
        .groupBy(LANDING_KEY, day.alias("dt"), F.bitmap_bucket_number(user).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"))
    )


def installs_partials(installs: DataFrame, day) -> DataFrame:
    """``ymd, install_dt, installs``."""
    return installs.groupBy(LANDING_KEY, day.alias("install_dt")).agg(F.count(F.lit(1)).alias("installs"))


def users_partials(events: DataFrame, day, user_col: str = "user_id") -> DataFrame:
    """``ymd, user_id, last_active_dt``."""
    return events.groupBy(LANDING_KEY, F.col(user_col).cast("string").alias("user_id")).agg(F.max(day).alias("last_active_dt"))


def refresh_partials(partials, events: DataFrame, path: str, days: Iterable[str], *args) -> None:
    """Compute ``partials`` (one of the above) of the landing ``days`` alone,
    a partition filter on ``events``, and replace them in the panel at
    ``path``; days without rows are emptied."""
    days = sorted(set(days))
    commit_keys(partials(events.where(F.col(LANDING_KEY).isin(days)), *args), path, LANDING_KEY, days)


def dau(panel: DataFrame) -> DataFrame:
    """``dt, dau`` from stored activity: bitmaps of a day and bucket are
    united first, a day's buckets added up then."""
    united = panel.groupBy("dt", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return united.groupBy("dt").agg(F.sum(F.bitmap_count("users")).alias("dau"))


def installs_daily(panel: DataFrame) -> DataFrame:
    """``install_dt, installs`` from stored counts."""
    return panel.groupBy("install_dt").agg(F.sum("installs").alias("installs"))


def user_panel(panel: DataFrame) -> DataFrame:
    """``user_id, last_active_dt`` from stored users."""
    return panel.groupBy("user_id").agg(F.max("last_active_dt").alias("last_active_dt"))
