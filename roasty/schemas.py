"""Declared schemas of every table the library reads or writes.

Feeds are declared rather than inferred: an all-empty column (the in-app
cost) would otherwise come back as a string and break the union with the
installs feed. Timestamps are ``timestamp_ntz`` holding UTC wall-clock
time, so no result depends on the session time zone of whichever cluster
runs the job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str | None = None) -> T.StructField:
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, True, meta)


S, D, L, TS, DT, B, I = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.TimestampNTZType(),
    T.DateType(),
    T.BooleanType(),
    T.IntegerType(),
)

# Installs feed: 20 columns in landing-file order.
INSTALLS = T.StructType(
    [
        _f("install_time", TS),
        _f("event_time", TS),
        _f("event_name", S),
        _f("event_revenue", D),
        _f("event_value", S, "raw JSON text, passed through"),
        _f("event_revenue_usd", D),
        _f("af_cost_model", S),
        _f("af_cost_value", D),
        _f("af_cost_currency", S),
        _f("event_source", S),
        _f("media_source", S),
        _f("af_channel", S),
        _f("af_keywords", S),
        _f("install_app_store", S),
        _f("campaign", S),
        _f("country_code", S),
        _f("platform", S),
        _f("app_version", S),
        _f("app_name", S),
        _f("appsflyer_id", S),
    ]
)

# In-app feed: 18 columns, a different order, no cost model and no device id.
# Its cost columns are empty in every row, so they are declared as strings
# and replaced by typed NULLs when the fact is built.
INAPP = T.StructType(
    [
        _f("install_time", TS),
        _f("event_time", TS),
        _f("event_name", S),
        _f("event_value", S),
        _f("event_revenue", D),
        _f("event_revenue_usd", D),
        _f("af_cost_currency", S),
        _f("af_cost_value", S),
        _f("media_source", S),
        _f("campaign", S),
        _f("af_channel", S),
        _f("country_code", S),
        _f("event_source", S),
        _f("af_keywords", S),
        _f("install_app_store", S),
        _f("platform", S),
        _f("app_version", S),
        _f("app_name", S),
    ]
)

FEEDS = {"installs": INSTALLS, "inapp": INAPP}

# Fact: the event date followed by the installs columns, in that order.
FACT_COLUMNS = ["dt"] + [f.name for f in INSTALLS.fields]
FACT = T.StructType([_f("dt", DT, "event date, DATE(event_time)")] + list(INSTALLS.fields))
FACT_TAGGED = T.StructType(list(FACT.fields) + [_f("data_source", S, "feed the row came from")])
LANDED = "landed"
FACT_LANDED = T.StructType(list(FACT_TAGGED.fields) + [_f(LANDED, S, "landing day of the row's file, yyyyMMdd")])
#: How the fact is partitioned on disk: by event day, and within it by where
#: the rows came from, so that a landing day can be replaced alone.
FACT_KEYS = ["dt", "data_source", LANDED]

# The event names, platforms and channels the panels pivot on,
# and the column names the two panel variants give them.
PANEL_EVENTS = ["install", "af_purchase", "SessionStart", "SessionEnd", "TournamentStart", "TournamentFinished"]
PANEL_PLATFORMS = ["ios", "android"]
PANEL_CHANNELS = ["Facebook", "Google", "TikTok", "Organic"]

PANEL_BY_INSTALL_COUNT_NAMES = {
    "event_name": {
        "install": "t_installs",
        "af_purchase": "t_af_purchase",
        "SessionStart": "t_SessionStart",
        "SessionEnd": "t_SessionEnd",
        "TournamentStart": "t_TournamentStart",
        "TournamentFinished": "t_TournamentFinished",
    },
    "platform": {"ios": "t_ios_users", "android": "t_android_users"},
    "af_channel": {
        "Facebook": "t_users_from_facebook",
        "Google": "t_users_from_Google",
        "TikTok": "t_users_from_TikTok",
        "Organic": "t_users_from_Organic",
    },
}

PANEL_BY_INSTALL = T.StructType(
    [
        _f("campaign", S),
        _f("dt", DT, "activity date"),
        _f("media_source", S, "greatest channel of the group"),
        _f("is_install", S, "install or non_install"),
        _f("t_events", L, "total events"),
    ]
    + [_f(n, L, f"rows with {c} = '{v}'") for c, m in PANEL_BY_INSTALL_COUNT_NAMES.items() for v, n in m.items()]
    + [_f("revenue", D, "total revenue, rounded"), _f("cost", D, "total cost, rounded")]
)

PANEL_CAMPAIGN = T.StructType(
    [
        _f("campaign", S),
        _f("dt", DT, "activity date"),
        _f("media_source", S, "greatest channel of the group"),
        _f("t_events", L, "total events"),
    ]
    + [
        _f(f"t_{v}", L, f"rows with {c} = '{v}'")
        for c, vs in (("event_name", PANEL_EVENTS), ("platform", PANEL_PLATFORMS), ("af_channel", PANEL_CHANNELS))
        for v in vs
    ]
    + [
        _f("revenue", D, "total revenue, rounded"),
        _f("cost", D, "total cost, rounded"),
        _f("roas", D, "revenue_usd / cost, NULL when cost is 0 or NULL"),
        _f("data_source", S, "greatest feed of the group"),
    ]
)

# Job log: one row per step of every job run.
JOB_LOG = T.StructType(
    [
        _f("ts", TS),
        _f("dt", S, "yyyy-MM-dd"),
        _f("uid", S),
        _f("username", S),
        _f("job_name", S),
        _f("job_type", S),
        _f("file_name", S),
        _f("step_name", S),
        _f("step_id", I),
        _f("log_type", S),
        _f("message", S, "command line of the run"),
    ]
)

LOG_STEPS = ["start", "success", "error", "end", "sql_not_found", "skipped"]

# Every check returns this shape so results of different checks union.
CHECK_RESULT = T.StructType(
    [
        _f("raise_flag", B),
        _f("kpi", S),
        _f("dt", DT),
        _f("metric", D),
        _f("previous_metric", S),
        _f("table_name", S),
    ]
)
CHECK_COLUMNS = [f.name for f in CHECK_RESULT.fields]

LOG_EXPECTATION = T.StructType(
    [
        _f("alert_name", S),
        _f("job_type", S),
        _f("job_name", S),
        _f("file_name", S),
        _f("step_name", S),
        _f("message", S, "LIKE pattern, NULL = no message filter"),
        _f("thresh_in_hours", I),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the column order, types and column comments of ``schema``
    (a projection: no data moves). Written tables keep the comments."""
    return df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields]
    )
