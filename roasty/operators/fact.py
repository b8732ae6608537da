"""The fact table: both feeds aligned to one column list and unioned."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roasty.functions.dates import as_date, days_back
from roasty.operators.incremental import LATE_MODES, lookback, overwrite_partitions, reject_late, replace_window
from roasty.schemas import FACT, FACT_LANDED, FACT_TAGGED, LANDED, conform


def align_to_fact(feed: DataFrame, landing_key: str | None = None) -> DataFrame:
    """Project a feed onto the fact columns (``DATE(event_time) AS dt``
    first). Columns the feed lacks become typed NULLs. Text where the fact
    has another type (the in-app cost) is parsed: blank is NULL, a value that
    does not parse fails the job, naming column and value. Other types are
    cast. Extra feed columns are dropped; the landing day is kept as
    ``landed`` if ``landing_key`` names it."""
    have = dict((f.name, f.dataType) for f in feed.schema.fields)
    cols = []
    for f in FACT.fields:
        if f.name == "dt":
            cols.append(F.to_date("event_time").alias("dt"))
        elif f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f.name))
        elif have[f.name].typeName() == "string" and f.dataType.typeName() != "string":
            cols.append(_parsed(f.name, f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
    if landing_key:
        cols.append(F.col(landing_key).alias(LANDED))
    return feed.select(*cols)


def _parsed(name: str, to):
    """A text column as another type; blank is NULL."""
    text = F.trim(F.col(name))
    value = text.try_cast(to)
    bad = F.raise_error(F.concat(F.lit(f"{name} does not hold a {to.simpleString()}: "), text)).cast(to)
    return F.when(value.isNotNull(), value).when(F.coalesce(text, F.lit("")) != "", bad)


def union_tagged(relations: Mapping[str, DataFrame], source_col: str | None = "data_source") -> DataFrame:
    """Union by name over the superset of columns, each row tagged with the
    name of its relation (``None`` for no tag). Missing columns are NULL."""
    parts = []
    for name, df in relations.items():
        parts.append(df.withColumn(source_col, F.lit(name)) if source_col else df)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def build_fact(installs: DataFrame, inapp: DataFrame, tag: bool = True, landing_key: str | None = None) -> DataFrame:
    """Fact rows of both feeds: 21 columns, plus ``data_source`` when tagged,
    plus ``landed``, the landing day, if ``landing_key`` names its column
    (then always tagged: the two say where a row came from).

    A narrow plan: two scans, two projections, one union; no shuffle.
    """
    rel = {"installs": align_to_fact(installs, landing_key), "inapp": align_to_fact(inapp, landing_key)}
    out = union_tagged(rel, "data_source" if tag or landing_key else None)
    return conform(out, FACT_LANDED if landing_key else FACT_TAGGED if tag else FACT)


def init_fact(spark: SparkSession, tag: bool = False) -> DataFrame:
    """The empty fact with the union schema (``CREATE TABLE ... AS SELECT
    ... WHERE FALSE``)."""
    return spark.createDataFrame([], FACT_TAGGED if tag else FACT)


def feed_since(feed: DataFrame, from_ymd: str, key: str = "ymd") -> DataFrame:
    """Rows of landing days ``>= from_ymd`` (the sharded-table suffix
    filter). On a table partitioned by ``ymd`` this prunes partitions."""
    return feed.where(F.col(key) >= F.lit(from_ymd))


def refresh_fact(
    target: DataFrame,
    installs: DataFrame,
    inapp: DataFrame,
    from_date,
    late: str = "widen",
    tag: bool = True,
    landing_key: str = "ymd",
) -> DataFrame:
    """Refresh of the fact from the landing days ``>= from_date``.

    A target that has ``landed`` (see ``build_fact``) says which landing day
    each row came from, and the refresh replaces the rows of those landing
    days: what a landing day brought is in the fact once, whatever its event
    time (late, early or none) and however often the refresh is run. Landing
    days that a feed's raw no longer reaches back to stay as they are. With
    ``late="drop"`` days before ``from_date`` are left as they are, and
    ``"reject"`` fails the job on a new row of such a day.

    A target without ``landed`` is refreshed by event day: days ``>=
    from_date`` are replaced, and with ``late="widen"`` (default) each earlier
    day that the new files hold events of, as far as both raw tables reach
    back. Other new rows are added as far as the fact lacks rows of their
    values, so equal rows without a time from two landing days count once:
    keep ``landed`` where that matters.
    """
    from_ymd = F.date_format(as_date(from_date), "yyyyMMdd")
    if LANDED in target.columns:
        return _refresh_by_landing(target, installs, inapp, from_date, late, landing_key)
    window = build_fact(
        installs.where(F.col(landing_key) >= from_ymd), inapp.where(F.col(landing_key) >= from_ymd), tag
    )
    frm, dt = as_date(from_date), F.col("dt")
    early = first_landing(from_date)
    if late != "widen":
        rows = build_fact(installs.where(F.col(landing_key) >= early), inapp.where(F.col(landing_key) >= early), tag)
        late_rows = window.where((dt < frm) | dt.isNull())
        return replace_window(target, rows.where(dt >= frm).unionByName(late_rows), "dt", from_date, late)
    # One value per late day, and the oldest landing day: scalar subqueries.
    late_days = window.where(dt < frm).agg(F.collect_set("dt")).scalar()
    # A day can be rebuilt only if no feed's raw has lost it.
    oldest = F.greatest(*[f.agg(F.min(landing_key)).scalar() for f in (installs, inapp)])
    whole = (dt >= frm) | (F.array_contains(late_days, dt) & (F.date_format(dt, "yyyyMMdd") >= oldest))
    start = F.date_format(F.date_sub(F.least(frm, F.coalesce(F.array_min(late_days), frm)), LEAD_DAYS), "yyyyMMdd")
    new = build_fact(installs.where(F.col(landing_key) >= start), inapp.where(F.col(landing_key) >= start), tag)
    kept = target.where(F.coalesce(~whole, F.lit(True)))
    # Days that raw no longer holds: few rows, compared with the same days of
    # the fact alone.
    gone = dt.isNull() | (F.array_contains(late_days, dt) & (F.date_format(dt, "yyyyMMdd") < oldest))
    missing = window.where(gone).select(*target.columns).exceptAll(kept.where(gone))
    return kept.unionByName(new.where(whole).select(*target.columns)).unionByName(missing)


def _refresh_by_landing(target, installs, inapp, from_date, late, landing_key):
    if late not in LATE_MODES:
        raise ValueError(f"late must be one of {LATE_MODES}, got {late!r}")
    frm, dt = as_date(from_date), F.col("dt")
    from_ymd = F.date_format(frm, "yyyyMMdd")
    new = build_fact(
        installs.where(F.col(landing_key) >= from_ymd), inapp.where(F.col(landing_key) >= from_ymd), landing_key=landing_key
    )
    held = F.lit(False)
    for name, feed in (("installs", installs), ("inapp", inapp)):
        reaches = F.col(LANDED) >= feed.agg(F.min(landing_key)).scalar()
        held = held | ((F.col("data_source") == name) & reaches)
    replaced = (F.col(LANDED) >= from_ymd) & held
    if late == "reject":
        new = reject_late(new, "dt", from_date)
    elif late == "drop":
        here = (dt >= frm) | dt.isNull()
        new, replaced = new.where(here), replaced & here
    return target.where(F.coalesce(~replaced, F.lit(True))).unionByName(new.select(*target.columns))


#: An event may be dated so many days after the day it landed (clocks that are
#: ahead, other time zones).
LEAD_DAYS = 1


def first_landing(day):
    """The first landing day (``yyyyMMdd``) that can hold events of ``day``."""
    return F.date_format(F.date_sub(as_date(day), LEAD_DAYS), "yyyyMMdd")


def check_lead(feed: DataFrame, landing_key: str = "ymd") -> DataFrame:
    """Fails the job, in the task that meets it, on an event dated more than
    LEAD_DAYS after its landing day: a later refresh would not find it."""
    day = F.to_date("event_time")
    last = F.date_add(F.to_date(F.try_to_timestamp(landing_key, F.lit("yyyyMMdd"))), LEAD_DAYS)
    bad = F.raise_error(F.concat(F.lit("event dated after its landing day "), F.col(landing_key), F.lit(": "), F.col("event_time").cast("string")))
    return feed.withColumn(landing_key, F.when(day > last, bad.cast("string")).otherwise(F.col(landing_key)))


def refresh_fact_lookback(
    target: DataFrame,
    installs: DataFrame,
    inapp: DataFrame,
    as_of,
    lookback_days: int = 7,
    tag: bool = True,
    landing_key: str | None = "ymd",
) -> DataFrame:
    """Partition overwrite of the last ``lookback_days`` event days.

    An event lands LEAD_DAYS before its day at the earliest, so the feeds are
    also cut to the landing days that can hold the window (pruning the raw
    tables) without changing the result."""
    if landing_key:
        first = first_landing(days_back(as_of, lookback_days))
        installs = installs.where(F.col(landing_key) >= first)
        inapp = inapp.where(F.col(landing_key) >= first)
    new = lookback(build_fact(installs, inapp, tag), "dt", as_of, lookback_days)
    return overwrite_partitions(target, new, "dt")
