"""Daily campaign panels built from the fact table.

The rows meet a hash aggregation whose partial aggregates are computed
map-side, so only one row per group and input partition is shuffled, and a
campaign holding a third of all rows costs no more than any other. A second,
small aggregation over those groups takes the string maxima.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roasty.functions.aggregates import conditional_counts, count_rows, money_merge, money_round, money_total, ratio
from roasty.functions.dates import as_date, days_back
from roasty.operators.incremental import overwrite_partitions, replace_window
from roasty.schemas import (
    PANEL_BY_INSTALL,
    PANEL_BY_INSTALL_COUNT_NAMES,
    PANEL_CAMPAIGN,
    PANEL_CHANNELS,
    PANEL_EVENTS,
    PANEL_PLATFORMS,
    conform,
)


def is_install_label():
    """``CASE WHEN event_name = 'install' THEN event_name ELSE 'non_install' END``."""
    return F.when(F.col("event_name") == F.lit("install"), F.col("event_name")).otherwise(F.lit("non_install"))


def _count_columns(by_install: bool) -> dict[str, dict[str, str]]:
    """Output names of the conditional counts of a panel, by column and value."""
    if by_install:
        return PANEL_BY_INSTALL_COUNT_NAMES
    values = {"event_name": PANEL_EVENTS, "platform": PANEL_PLATFORMS, "af_channel": PANEL_CHANNELS}
    return {c: {v: f"t_{v}" for v in vs} for c, vs in values.items()}


def campaign_panel(fact: DataFrame, by_install: bool = True) -> DataFrame:
    """Conditional event counts, revenue and cost per campaign and day.

    ``by_install=True``: grain (campaign, dt, is_install), 19 columns.
    ``by_install=False``: grain (campaign, dt), 20 columns with ``roas`` and
    ``data_source``. ``media_source`` is the greatest ``af_channel`` of the
    group; a count with no matching row is NULL; revenue and cost are rounded
    half away from zero.

    Plan: a string ``MAX`` has no fixed-width aggregation buffer, and Spark
    would sort every input row to aggregate it. So the rows are first
    hash-aggregated at the grain plus the string columns (channel, feed),
    where every measure is a count or an exact decimal sum, and only
    that small result is aggregated again to the panel grain with the
    maxima. Both steps are exact: counts and decimal sums add up.
    """
    keys = ["campaign", "dt"] + (["is_install"] if by_install else [])
    has_tag = "data_source" in fact.columns and not by_install
    src = fact.withColumn("is_install", is_install_label()) if by_install else fact
    strings = ["af_channel"] + (["data_source"] if has_tag else [])
    counts = _count_columns(by_install)
    money = {"revenue": "event_revenue", "cost": "af_cost_value"}
    if not by_install:
        money["revenue_usd"] = "event_revenue_usd"
    fine = src.groupBy(*keys, *strings).agg(
        count_rows().alias("_n"),
        *[n for c, names in counts.items() for n in conditional_counts(c, names, {v: f"_{name}" for v, name in names.items()})],
        *[money_total(col).alias(f"_u_{name}") for name, col in money.items()],
    )
    panel = fine.groupBy(*keys).agg(
        F.max("af_channel").alias("media_source"),
        F.sum("_n").cast("long").alias("t_events"),
        *[F.sum(f"_{n}").cast("long").alias(n) for names in counts.values() for n in names.values()],
        *[money_merge(f"_u_{name}").alias(f"_m_{name}") for name in money],
        (F.max("data_source") if has_tag else F.lit(None).cast("string")).alias("data_source"),
    )
    panel = panel.withColumn("revenue", money_round("_m_revenue")).withColumn("cost", money_round("_m_cost"))
    if by_install:
        return conform(panel, PANEL_BY_INSTALL)
    panel = panel.withColumn("roas", ratio(F.col("_m_revenue_usd"), F.col("_m_cost")))
    return conform(panel, PANEL_CAMPAIGN)


def panel_up_to(fact: DataFrame, up_to, by_install: bool = True) -> DataFrame:
    """Full build over ``dt <= up_to``. The filter is on the partition
    column, below the aggregate, so the scan prunes partitions."""
    return campaign_panel(fact.where(F.col("dt") <= as_date(up_to)), by_install)


def panel_since(fact: DataFrame, from_date, by_install: bool = True) -> DataFrame:
    """Incremental aggregate over ``dt >= from_date``."""
    return campaign_panel(fact.where(F.col("dt") >= as_date(from_date)), by_install)


def panel_lookback(fact: DataFrame, as_of, lookback_days: int = 7, by_install: bool = False) -> DataFrame:
    """Panel rows of the look-back window ``dt >= as_of - lookback_days``.
    The filter is on a group key; Catalyst moves it below the aggregate."""
    return campaign_panel(fact, by_install).where(F.col("dt") >= days_back(as_of, lookback_days))


def campaign_kpis(fact: DataFrame) -> DataFrame:
    """Dashboard grain (dt, media_source, campaign) from the fact: installs,
    events, revenue, cost and cost per install (NULL without installs). The
    ratio is taken from the unrounded cost; revenue and cost are shown to the
    cent."""
    g = fact.groupBy("dt", "media_source", "campaign").agg(
        F.count(F.when(F.col("event_name") == F.lit("install"), F.lit(1))).alias("installs"),
        count_rows().alias("events"),
        money_total("event_revenue").alias("_revenue"),
        money_total("af_cost_value").alias("_cost"),
    )
    return g.select(
        "dt",
        "media_source",
        "campaign",
        "installs",
        "events",
        money_round("_revenue", 2).alias("revenue"),
        money_round("_cost", 2).alias("cost"),
        ratio(F.col("_cost"), F.col("installs")).alias("cpi"),
    )


def channel_daily(fact: DataFrame) -> DataFrame:
    """Installs, events and revenue by channel and day."""
    return fact.groupBy("dt", "af_channel").agg(
        F.sum(F.when(F.col("event_name") == F.lit("install"), F.lit(1))).cast("long").alias("installs"),
        count_rows().alias("events"),
        money_round(money_total("event_revenue"), 2).alias("revenue"),
        money_round(money_total("af_cost_value"), 2).alias("cost"),
    )


def refresh_panel(target: DataFrame, fact: DataFrame, from_date, by_install: bool = True) -> DataFrame:
    """Window replace of the panel from ``from_date`` on."""
    return replace_window(target, panel_since(fact, from_date, by_install), "dt", from_date, late="reject")


def refresh_panel_lookback(target: DataFrame, fact: DataFrame, as_of, lookback_days: int = 7, by_install: bool = False) -> DataFrame:
    """Partition overwrite of the panel's look-back window."""
    return overwrite_partitions(target, panel_lookback(fact, as_of, lookback_days, by_install), "dt")


def daily_counts(df: DataFrame, key: str = "dt", top: int = 100) -> DataFrame:
    """Row count per day, newest first, the ``top`` newest days (a top-k:
    each partition keeps its ``top`` rows before the merge)."""
    return df.groupBy(key).agg(count_rows().alias("cnt")).orderBy(F.col(key).desc()).limit(top)
