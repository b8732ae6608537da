"""The daily job chain on disk: landing files -> raw tables -> fact ->
panel, and a range backfill as one job.

Each stage writes a table, so a lost executor costs at most the stage it
was in, and a failed run is repaired by running it again: every write
replaces whole partitions and no stage reads the partitions it replaces.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from roasty.functions.dates import as_date
from roasty.operators import fact as fact_ops
from roasty.operators import incremental as inc
from roasty.operators import panel as panel_ops
from roasty.schemas import FACT_KEYS, FACT_LANDED, FACT_TAGGED, FEEDS, PANEL_BY_INSTALL, PANEL_CAMPAIGN, conform
from roasty.sources import landing


@dataclass(frozen=True)
class Layout:
    """Where each table of the chain lives. ``landing_template`` names the
    landing files of one feed and day (``{root}``, ``{feed}``, ``{day}`` =
    yyyyMMdd); globs are allowed."""

    landing_root: str
    raw_root: str
    fact_path: str
    panel_path: str
    landing_template: str = "{root}/{day}/{feed}.csv"
    feeds: tuple = ("installs", "inapp")
    by_install: bool = True

    def raw_path(self, feed: str) -> str:
        return f"{self.raw_root.rstrip('/')}/{feed}"

    def landing_paths(self, feed: str, days: list[str]) -> list[str]:
        root = self.landing_root.rstrip("/")
        return [self.landing_template.format(root=root, feed=feed, day=d) for d in days]


def _read_table(spark: SparkSession, path: str, schema):
    """A table of the chain with its declared schema (no inference over the
    partition folders; a partitioned read puts the partition column last, so
    back to the declared order); empty before anything was written."""
    if not landing.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return conform(spark.read.schema(schema).parquet(path), schema)


def read_fact(spark: SparkSession, layout: Layout, landed: bool = False):
    """The fact table, with the landing day of each row if ``landed``."""
    return _read_table(spark, layout.fact_path, FACT_LANDED if landed else FACT_TAGGED)


def read_panel(spark: SparkSession, layout: Layout):
    """The panel table."""
    return _read_table(spark, layout.panel_path, PANEL_BY_INSTALL if layout.by_install else PANEL_CAMPAIGN)


def _ymd(d: _dt.date) -> str:
    return d.strftime("%Y%m%d")


def _days(first: _dt.date, last: _dt.date) -> list[str]:
    n = (last - first).days
    return [_ymd(first + _dt.timedelta(days=i)) for i in range(n + 1)]


def load_landing(spark: SparkSession, layout: Layout, days: list[str]) -> None:
    """Load the given landing days of every feed into its raw table (one
    job per feed, however many days)."""
    for feed in layout.feeds:
        df = landing.read_landing(spark, layout.landing_paths(feed, days), schema=FEEDS[feed])
        landing.load_raw(fact_ops.check_lead(df), layout.raw_path(feed), days)


def _held(spark: SparkSession, layout: Layout, delivered=()):
    """Whether the raw tables answer for what a feed's landing day brought:
    the day was just delivered, or the feed's raw reaches back to it (a day
    without rows is then empty, not expired)."""
    oldest = {f: min(inc.partition_values(spark, layout.raw_path(f), "ymd"), default=None) for f in layout.feeds}
    delivered = set(delivered)

    def held(feed: str, landed: str) -> bool:
        reach = oldest.get(feed)
        return landed in delivered or (reach is not None and landed >= reach)

    return held


def refresh_fact_on_disk(spark: SparkSession, layout: Layout, from_date, late: str = "widen",
                         delivered=()) -> list[_dt.date]:
    """Refresh the fact from the landing days ``>= from_date`` and return the
    event days before it that changed, then ``from_date``.

    The fact keeps the landing day and feed of its rows as partitions, so the
    pieces that those landing days brought are replaced, whatever their event
    days: late and early rows and rows without a time are in the fact once,
    however often this runs. Pieces of landing days that a feed's raw no
    longer reaches back to stay, unless ``delivered`` names the day.

    ``late="drop"`` leaves event days before ``from_date`` as they are;
    ``"reject"`` fails the job on a new row of one."""
    if late not in inc.LATE_MODES:
        raise ValueError(f"late must be one of {inc.LATE_MODES}, got {late!r}")
    first = from_date if isinstance(from_date, _dt.date) else _dt.date.fromisoformat(str(from_date))
    frm, frm_ymd = first.isoformat(), _ymd(first)
    raw = {f: landing.read_raw(spark, layout.raw_path(f), FEEDS[f], frm_ymd) for f in layout.feeds}
    new, dt = fact_ops.build_fact(raw["installs"], raw["inapp"], landing_key="ymd"), F.col("dt")
    if late == "reject":
        new = inc.reject_late(new, "dt", first)
    elif late == "drop":
        new = new.where((dt >= F.lit(first)) | dt.isNull())
    held = _held(spark, layout, delivered)

    def stale(piece, _written) -> bool:
        day, feed, landed = piece
        here = late == "widen" or day == inc.NULL_PARTITION or day >= frm
        return here and frm_ymd <= landed != inc.NULL_PARTITION and held(feed, landed)

    written, dropped = inc.commit_pieces(new, layout.fact_path, FACT_KEYS, stale)
    days = {day for day, _, _ in written | dropped} - {inc.NULL_PARTITION}
    return [*sorted(_dt.date.fromisoformat(d) for d in days if d < frm), first]


def refresh_panel_on_disk(spark: SparkSession, layout: Layout, from_date, late_days=()) -> None:
    """Rewrite the panel's days ``>= from_date``, the ``late_days`` before it
    and the group of rows without a day, from the fact on disk."""
    dt = F.col("dt")
    days = (dt >= as_date(from_date)) | dt.isNull()
    if late_days:
        days = days | dt.isin(list(late_days))
    new = panel_ops.campaign_panel(read_fact(spark, layout).where(days), layout.by_install)
    schema = PANEL_BY_INSTALL if layout.by_install else PANEL_CAMPAIGN
    inc.commit_window(new.select(*schema.fieldNames()), layout.panel_path, "dt", from_date, also=late_days)


def run_daily(spark: SparkSession, layout: Layout, as_of, days_back: int = 1, logger=None,
              late: str = "widen") -> _dt.date:
    """The daily action for the day ``as_of - days_back``: load its landing
    files, then refresh fact and panel from that day on, in that order."""
    day = (as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))) - _dt.timedelta(days=days_back)
    return backfill(spark, layout, day, day, logger, late)


def backfill(spark: SparkSession, layout: Layout, first_day, last_day, logger=None, late: str = "widen") -> _dt.date:
    """Reload landing days ``first_day .. last_day`` and rebuild fact and
    panel from ``first_day`` on, as one job per stage. Equal in final state
    to running the daily action for each day in turn."""
    first = first_day if isinstance(first_day, _dt.date) else _dt.date.fromisoformat(str(first_day))
    last = last_day if isinstance(last_day, _dt.date) else _dt.date.fromisoformat(str(last_day))
    if logger:
        logger.log("start")
    try:
        delivered = _days(first, last)
        load_landing(spark, layout, delivered)
        days = refresh_fact_on_disk(spark, layout, first, late, delivered)
        refresh_panel_on_disk(spark, layout, first, days[:-1])
    except Exception:
        if logger:
            logger.log("error")
        raise
    if logger:
        logger.log("success")
        logger.log("end")
    return min(days)


def run_lookback(spark: SparkSession, layout: Layout, as_of, lookback_days: int = 7, logger=None) -> None:
    """The partition-overwrite flavour of the daily run: load the landing
    days of the look-back window, then overwrite the fact partitions of
    event days ``>= as_of - lookback_days`` and the panel partitions of the
    same days (days with no new rows keep their rows)."""
    day = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))
    first = day - _dt.timedelta(days=lookback_days)
    if logger:
        logger.log("start")
    try:
        delivered = _days(first, day)
        load_landing(spark, layout, delivered)
        early = _ymd(first - _dt.timedelta(days=fact_ops.LEAD_DAYS))
        raw = {f: landing.read_raw(spark, layout.raw_path(f), FEEDS[f], early) for f in layout.feeds}
        fact = fact_ops.build_fact(raw["installs"], raw["inapp"], landing_key="ymd")
        held = _held(spark, layout, delivered)

        def stale(piece, written) -> bool:
            """Of the days overwritten, what raw has no rows of any more."""
            return piece[0] in {w[0] for w in written} and held(piece[1], piece[2])

        inc.commit_pieces(inc.lookback(fact, "dt", day, lookback_days), layout.fact_path, FACT_KEYS, stale)
        panel = panel_ops.panel_lookback(read_fact(spark, layout), day, lookback_days, layout.by_install)
        schema = PANEL_BY_INSTALL if layout.by_install else PANEL_CAMPAIGN
        inc.commit_partitions(panel.select(*schema.fieldNames()), layout.panel_path, "dt")
    except Exception:
        if logger:
            logger.log("error")
        raise
    if logger:
        logger.log("success")
        logger.log("end")


# The step kinds a job configuration names (its ``sql`` field).
JOB_STEPS = ("fact_init", "fact_daily", "daily_panel_init", "daily_panel_daily")


def run_step(spark: SparkSession, layout: Layout, step: str, day: _dt.date, late: str = "widen", late_days=()) -> list[_dt.date]:
    """One configured step for the day ``day``; returns the days before it
    that the fact changed in (``late_days`` for the panel step after it):

    * ``fact_init``: the empty fact table with the union schema;
    * ``fact_daily``: window replace of the fact from ``day``;
    * ``daily_panel_init``: full panel build of days ``<= day``;
    * ``daily_panel_daily``: window replace of the panel from ``day``.
    """
    if step == "fact_init":
        inc.init_table(spark, layout.fact_path, FACT_LANDED, FACT_KEYS)
    elif step == "fact_daily":
        return refresh_fact_on_disk(spark, layout, day, late)[:-1]
    elif step == "daily_panel_init":
        schema = PANEL_BY_INSTALL if layout.by_install else PANEL_CAMPAIGN
        panel = panel_ops.panel_up_to(read_fact(spark, layout), day, layout.by_install)
        inc.commit_full(panel.select(*schema.fieldNames()), layout.panel_path, "dt")
    elif step == "daily_panel_daily":
        refresh_panel_on_disk(spark, layout, day, late_days)
    else:
        raise ValueError(f"unknown step {step!r} (one of {JOB_STEPS})")
    return []


def run_jobs(spark: SparkSession, layout: Layout, config: dict, action: str, as_of, days_back: int = 1,
             jobs: list[str] | None = None, logger_for=None) -> list[str]:
    """Run the enabled ``action`` of every job of a job configuration
    (``{"etl_jobs": {job: {action: {"enabled": ..., "sql": step}}}}``) in
    configuration order, for the day ``as_of - days_back``. Returns the steps
    run.

    Per job, ``logger_for(job)`` (a ``JobLogger`` or None) gets ``start``,
    then ``success`` and ``end``; a failing step logs ``error`` and stops the
    chain; an unknown step logs ``sql_not_found`` and the chain goes on with
    the next job; an entry without a step logs ``start`` and ``end`` only. A
    single job asked for by name (``jobs=[name]``) that is not enabled logs
    ``skipped``."""
    day = (as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of))) - _dt.timedelta(days=days_back)
    done: list[str] = []
    late_days: list[_dt.date] = []
    for job, actions in config["etl_jobs"].items():
        if jobs is not None and job not in jobs:
            continue
        conf = actions.get(action)
        logger = logger_for(job) if logger_for else None
        if not conf or not conf.get("enabled"):
            if jobs is not None and logger:
                logger.log("skipped")
            continue
        if logger:
            logger.log("start")
        step = conf.get("sql")
        if step is not None and step not in JOB_STEPS:
            if logger:
                logger.log("sql_not_found")
            continue
        if step is not None:
            try:
                late_days = [*late_days, *run_step(spark, layout, step, day, late_days=late_days)]
            except Exception:
                if logger:
                    logger.log("error")
                raise
            if logger:
                logger.log("success")
            done.append(step)
        if logger:
            logger.log("end")
    return done


def run_loader(spark: SparkSession, config: dict, etl_name: str, action: str, landing_root: str, raw_root: str,
               day, schemas: dict | None = None, checkpoint_root: str | None = None,
               fmt: str = "csv", logger=None) -> dict[str, str]:
    """The landing loader from a loader configuration
    (``{group: {etl_name: {action: {"enabled": ..., "dataset_id": ...}}}}``).

    ``daily``: every file of ``{landing_root}/{etl_name}/{yyyyMMdd}`` into
    the raw table named after the file, under ``{raw_root}/{dataset_id}``
    (``load_day_by_file``). ``hourly``: the files landed since the last run,
    by a file stream per declared table (``schemas``, files ``{table}.{fmt}``),
    and the days whose files were replaced or removed; both are kept track of
    under ``checkpoint_root``. Disabled actions load nothing. Returns
    ``{table: raw path}``."""
    if logger:
        logger.log("start")
    try:
        loaded = _load(spark, config, etl_name, action, landing_root, raw_root, day, schemas, checkpoint_root, fmt)
    except Exception:
        if logger:
            logger.log("error")
        raise
    if logger:
        logger.log("end")
    return loaded


def _load(spark, config, etl_name, action, landing_root, raw_root, day, schemas, checkpoint_root, fmt):
    from roasty.streaming.ingest import ingest_available

    loaded: dict[str, str] = {}
    for _group, etls in config.items():
        conf = etls.get(etl_name, {}).get(action)
        if not conf or not conf.get("enabled"):
            continue
        dest = f"{raw_root.rstrip('/')}/{conf.get('dataset_id', etl_name)}"
        src = f"{landing_root.rstrip('/')}/{etl_name}"
        if action == "hourly":
            if not schemas or not checkpoint_root:
                raise ValueError("the hourly load streams declared tables: give schemas and checkpoint_root")
            for table, schema in schemas.items():
                path, state = f"{dest}/{table}", f"{checkpoint_root.rstrip('/')}/{table}"
                ingest_available(spark, src, f"{table}.{fmt}", schema, path, state, manifest=f"{state}_files")
                loaded[table] = path
        else:
            d = day if isinstance(day, _dt.date) else _dt.date.fromisoformat(str(day))
            loaded.update(landing.load_day_by_file(spark, src, _ymd(d), dest, schemas))
    return loaded

