"""Adapters from the provided test tables to the attribution data model.

No attribution feed exists among the test tables, so one is derived from
``events`` (and a job log from ``orders``) by fixed rules. Every rule is a
built-in column expression; the adapters are plain projections that Spark
fuses into the scan stage, so the derived feeds grow with the tables.

Rules for ``events`` (``k`` = the integer at ``$.k`` of ``props``):

* event_type -> event_name: signup=install, purchase=af_purchase,
  click=SessionStart, view=SessionEnd, error=TournamentStart
  (TournamentFinished never occurs, so its panel count stays NULL).
* install rows form the installs feed, the rest the in-app feed.
* af_channel by k % 4, platform by k % 2, campaign ``c`` + k % 5 (a campaign
  spans several channels), country by k % 7, app version by k % 3.
* installs cost ``value`` (0.0 when organic); purchase revenue ``value``;
  install revenue 0.0; other revenue NULL.
* In-app rows land in the file of the day one hour after the event, so the
  last hour of a day arrives late, in the next day's file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roasty.schemas import INAPP, INSTALLS, JOB_LOG

# Fixed values of the adapter rules.
EVENT_NAMES = {
    "signup": "install",
    "purchase": "af_purchase",
    "click": "SessionStart",
    "view": "SessionEnd",
    "error": "TournamentStart",
}
CHANNELS = ["Google", "Facebook", "TikTok", "Organic"]  # by k % 4
MEDIA_SOURCES = {"Google": "googleadwords_int", "Facebook": "facebook_int", "TikTok": "tiktok_int", "Organic": "organic"}
PLATFORMS = ["ios", "android"]  # by k % 2
APP_STORES = {"ios": "itunes", "android": "google_play"}
COUNTRIES = ["US", "GB", "DE", "JP", "FR", "IN", "BR"]  # by k % 7
APP_NAME = "roasty_demo"

# Job-log rules for ``orders``: status -> step, id of the step.
ORDER_STEPS = {"F": ("end", 3), "O": ("start", 1), "P": ("error", 2)}
LOG_FILE = "daily_etl.py"


def _sql_list(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _sql_case(expr: str, mapping: dict[str, str]) -> str:
    return f"CASE {expr} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Each rule is one SQL expression; a feed is one projection of the scan.
_BASE = [
    "ts",
    "user_id",
    "event_type",
    "value",
    "props",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
]
_COMMON = [
    "ts",
    "user_id",
    "event_type",
    "value",
    "props",
    "k",
    _sql_case("event_type", EVENT_NAMES) + " AS event_name",
    f"element_at({_sql_list(CHANNELS)}, pmod(k, 4) + 1) AS af_channel",
    f"element_at({_sql_list(PLATFORMS)}, pmod(k, 2) + 1) AS platform",
    "concat('c', CAST(pmod(k, 5) AS STRING)) AS campaign",
    f"element_at({_sql_list(COUNTRIES)}, pmod(k, 7) + 1) AS country_code",
    "concat('1.5.', CAST(pmod(k, 3) + 1 AS STRING)) AS app_version",
]
_DERIVED = {
    "media_source": _sql_case("af_channel", MEDIA_SOURCES),
    "install_app_store": _sql_case("platform", APP_STORES),
    "af_keywords": "CASE WHEN af_channel = 'Organic' THEN CAST(NULL AS STRING) "
    "WHEN pmod(k, 10) = 9 THEN '  ' ELSE concat('kw', CAST(pmod(k, 3) AS STRING)) END",
    "event_source": "'SDK'",
    "event_value": "props",
    "app_name": f"'{APP_NAME}'",
    "event_time": "ts",
}
_INSTALLS = dict(
    _DERIVED,
    install_time="ts",
    event_revenue="0.0D",
    event_revenue_usd="0.0D",
    af_cost_model="CASE WHEN af_channel <> 'Organic' THEN 'CPI' END",
    af_cost_value="CASE WHEN af_channel = 'Organic' THEN 0.0D ELSE value END",
    af_cost_currency="CASE WHEN af_channel <> 'Organic' THEN 'USD' END",
    appsflyer_id="concat('af-', CAST(user_id AS STRING))",
    ymd="date_format(ts, 'yyyyMMdd')",
)
_INAPP = dict(
    _DERIVED,
    install_time="ts - make_dt_interval(pmod(k, 30) + 1)",
    event_revenue="CASE WHEN event_type = 'purchase' THEN value END",
    event_revenue_usd="CASE WHEN event_type = 'purchase' THEN value END",
    af_cost_currency="NULL",
    af_cost_value="NULL",
    ymd="date_format(ts + INTERVAL 1 HOUR, 'yyyyMMdd')",
)


def _project(df: DataFrame, rules: dict[str, str], schema) -> DataFrame:
    cols = [f"CAST({rules.get(f.name, f.name)} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema.fields]
    return df.selectExpr(*cols, f"{rules['ymd']} AS ymd")


def _enriched(events: DataFrame, installs: bool, *more: str) -> DataFrame:
    cond = "event_type = 'signup'" if installs else "event_type <> 'signup'"
    return events.where(cond).selectExpr(*_BASE, *more).selectExpr(*_COMMON, *more)


def installs_feed(events: DataFrame) -> DataFrame:
    """Installs feed (20 declared columns + ``ymd`` landing day)."""
    return _project(_enriched(events, True), _INSTALLS, INSTALLS)


def inapp_feed(events: DataFrame, landed: str | None = None) -> DataFrame:
    """In-app feed (18 declared columns + ``ymd`` landing day). ``landed``
    names a column of ``events`` with the time a row lands, if it is not the
    hour after the event."""
    if landed is None:
        return _project(_enriched(events, False), _INAPP, INAPP)
    return _project(_enriched(events, False, landed), dict(_INAPP, ymd=f"date_format({landed}, 'yyyyMMdd')"), INAPP)


def feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = read_table(spark, sf_dir, "events")
    return installs_feed(events), inapp_feed(events)


def dau(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dau(dt, dau)``: distinct users per day, in two aggregation steps
    (first by day and user, then by day) so that a huge day is spread over
    many tasks instead of one distinct-set per day."""
    ev = read_table(spark, sf_dir, "events").select(F.to_date("ts").alias("dt"), "user_id")
    return ev.distinct().groupBy("dt").agg(F.count(F.lit(1)).alias("dau"))


def installs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``installs(install_dt, installs)``."""
    inst, _ = feeds(spark, sf_dir)
    return inst.groupBy(F.to_date("install_time").alias("install_dt")).agg(F.count(F.lit(1)).alias("installs"))


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_panel(user_id, last_active_dt)``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.max(F.to_date("ts")).alias("last_active_dt")
    )


def job_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Job log (declared 11 columns, ``job_type`` = daily) from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    rules = {
        "ts": "o_orderdate",
        "dt": "date_format(o_orderdate, 'yyyy-MM-dd')",
        "uid": "lpad(hex(o_orderkey), 8, '0')",
        "username": "'etl'",
        "job_name": "o_orderpriority",
        "job_type": "'daily'",
        "file_name": f"'{LOG_FILE}'",
        "step_name": _sql_case("o_orderstatus", {k: v[0] for k, v in ORDER_STEPS.items()}),
        "step_id": _sql_case("o_orderstatus", {k: str(v[1]) for k, v in ORDER_STEPS.items()}),
        "log_type": "'prod'",
        "message": f"concat('{LOG_FILE} proj --etl-name ', o_orderpriority, "
        "' --etl-action daily --days-back ', CAST(pmod(o_custkey, 3) AS STRING))",
    }
    return o.selectExpr(*[f"CAST({rules[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in JOB_LOG.fields])
