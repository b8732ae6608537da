"""Independent DuckDB SQL for each registered query.

The same adapter rules as ``roasty.sources.adapters`` are restated in SQL
(``ADAPTER``), then each query is written against the resulting ``fact``,
feeds and derived panels. Two helpers state Spark's numeric semantics in
DuckDB terms: money sums of the amounts' shortest decimal forms, and rounding
of a double to n places half-up on its decimal value.
"""

from __future__ import annotations


def mtotal(expr: str) -> str:
    """Exact sum of amounts as a decimal: each by its shortest decimal form."""
    return f"SUM(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,18)))"


def msum(expr: str) -> str:
    """The exact sum as the nearest double (by way of text: a cast from a wide
    decimal can be one unit off in the last place)."""
    return f"CAST(CAST({mtotal(expr)} AS VARCHAR) AS DOUBLE)"


def mround(expr: str, n: int = 0) -> str:
    """The exact sum rounded half away from zero, as a double."""
    return f"CAST(ROUND({mtotal(expr)}, {n}) AS DOUBLE)"


def round_n(expr: str, n: int) -> str:
    """``ROUND(double, n)`` as Spark does it: half-up on the decimal value."""
    return f"CAST(ROUND(CAST(({expr}) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def csum(cond: str) -> str:
    """``SUM(CASE WHEN cond THEN 1 END)`` as BIGINT (NULL when none)."""
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 END) AS BIGINT)"


FACT_COLS = (
    "dt, install_time, event_time, event_name, event_revenue, event_value, event_revenue_usd, "
    "af_cost_model, af_cost_value, af_cost_currency, event_source, media_source, af_channel, "
    "af_keywords, install_app_store, campaign, country_code, platform, app_version, app_name, appsflyer_id"
)

ADAPTER = """
ev AS (
  SELECT ts, user_id, event_type, value, props,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
ev2 AS (
  SELECT *,
    CASE event_type WHEN 'signup' THEN 'install' WHEN 'purchase' THEN 'af_purchase'
      WHEN 'click' THEN 'SessionStart' WHEN 'view' THEN 'SessionEnd'
      WHEN 'error' THEN 'TournamentStart' END AS event_name,
    ['Google', 'Facebook', 'TikTok', 'Organic'][k % 4 + 1] AS af_channel,
    ['ios', 'android'][k % 2 + 1] AS platform,
    'c' || CAST(k % 5 AS VARCHAR) AS campaign,
    ['US', 'GB', 'DE', 'JP', 'FR', 'IN', 'BR'][k % 7 + 1] AS country_code,
    '1.5.' || CAST(k % 3 + 1 AS VARCHAR) AS app_version
  FROM ev
),
ev3 AS (
  SELECT *,
    CASE af_channel WHEN 'Google' THEN 'googleadwords_int' WHEN 'Facebook' THEN 'facebook_int'
      WHEN 'TikTok' THEN 'tiktok_int' WHEN 'Organic' THEN 'organic' END AS media_source,
    CASE platform WHEN 'ios' THEN 'itunes' WHEN 'android' THEN 'google_play' END AS install_app_store,
    CASE WHEN af_channel = 'Organic' THEN NULL WHEN k % 10 = 9 THEN '  '
      ELSE 'kw' || CAST(k % 3 AS VARCHAR) END AS af_keywords
  FROM ev2
),
installs AS (
  SELECT ts AS install_time, ts AS event_time, event_name,
    CAST(0.0 AS DOUBLE) AS event_revenue, props AS event_value, CAST(0.0 AS DOUBLE) AS event_revenue_usd,
    CASE WHEN af_channel <> 'Organic' THEN 'CPI' END AS af_cost_model,
    CASE WHEN af_channel = 'Organic' THEN CAST(0.0 AS DOUBLE) ELSE value END AS af_cost_value,
    CASE WHEN af_channel <> 'Organic' THEN 'USD' END AS af_cost_currency,
    'SDK' AS event_source, media_source, af_channel, af_keywords, install_app_store, campaign,
    country_code, platform, app_version, 'roasty_demo' AS app_name,
    'af-' || CAST(user_id AS VARCHAR) AS appsflyer_id,
    strftime(ts, '%Y%m%d') AS ymd
  FROM ev3 WHERE event_type = 'signup'
),
inapp AS (
  SELECT ts - to_days(k % 30 + 1) AS install_time, ts AS event_time, event_name, props AS event_value,
    CASE WHEN event_type = 'purchase' THEN value END AS event_revenue,
    CASE WHEN event_type = 'purchase' THEN value END AS event_revenue_usd,
    CAST(NULL AS VARCHAR) AS af_cost_currency, CAST(NULL AS VARCHAR) AS af_cost_value,
    media_source, campaign, af_channel, country_code, 'SDK' AS event_source, af_keywords,
    install_app_store, platform, app_version, 'roasty_demo' AS app_name,
    strftime(ts + INTERVAL 1 HOUR, '%Y%m%d') AS ymd
  FROM ev3 WHERE event_type <> 'signup'
),
fact_y AS (
  SELECT CAST(event_time AS DATE) AS dt, install_time, event_time, event_name, event_revenue,
    event_value, event_revenue_usd, af_cost_model, af_cost_value, af_cost_currency, event_source,
    media_source, af_channel, af_keywords, install_app_store, campaign, country_code, platform,
    app_version, app_name, appsflyer_id, 'installs' AS data_source, ymd
  FROM installs
  UNION ALL
  SELECT CAST(event_time AS DATE) AS dt, install_time, event_time, event_name, event_revenue,
    event_value, event_revenue_usd, CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE), af_cost_currency,
    event_source, media_source, af_channel, af_keywords, install_app_store, campaign, country_code,
    platform, app_version, app_name, CAST(NULL AS VARCHAR), 'inapp' AS data_source, ymd
  FROM inapp
),
fact AS (SELECT * EXCLUDE (ymd) FROM fact_y)
"""


def with_adapter(body: str, *extra_ctes: str) -> str:
    ctes = ",\n".join((ADAPTER.strip(),) + extra_ctes)
    return f"WITH {ctes}\n{body}"


def panel_by_install_sql(source: str = "fact", where: str = "TRUE") -> str:
    return f"""
SELECT campaign, dt, MAX(af_channel) AS media_source,
  CASE WHEN event_name = 'install' THEN event_name ELSE 'non_install' END AS is_install,
  COUNT(1) AS t_events,
  {csum("event_name = 'install'")} AS t_installs,
  {csum("event_name = 'af_purchase'")} AS t_af_purchase,
  {csum("event_name = 'SessionStart'")} AS t_SessionStart,
  {csum("event_name = 'SessionEnd'")} AS t_SessionEnd,
  {csum("event_name = 'TournamentStart'")} AS t_TournamentStart,
  {csum("event_name = 'TournamentFinished'")} AS t_TournamentFinished,
  {csum("platform = 'ios'")} AS t_ios_users,
  {csum("platform = 'android'")} AS t_android_users,
  {csum("af_channel = 'Facebook'")} AS t_users_from_facebook,
  {csum("af_channel = 'Google'")} AS t_users_from_Google,
  {csum("af_channel = 'TikTok'")} AS t_users_from_TikTok,
  {csum("af_channel = 'Organic'")} AS t_users_from_Organic,
  {mround("event_revenue")} AS revenue,
  {mround("af_cost_value")} AS cost
FROM {source}
WHERE {where}
GROUP BY ALL"""


def panel_campaign_sql(source: str = "fact", where: str = "TRUE") -> str:
    events = ["install", "af_purchase", "SessionStart", "SessionEnd", "TournamentStart", "TournamentFinished"]
    counts = [f"{csum(f'event_name = {chr(39)}{e}{chr(39)}')} AS t_{e}" for e in events]
    counts += [f"{csum(f'platform = {chr(39)}{p}{chr(39)}')} AS t_{p}" for p in ["ios", "android"]]
    counts += [f"{csum(f'af_channel = {chr(39)}{c}{chr(39)}')} AS t_{c}" for c in ["Facebook", "Google", "TikTok", "Organic"]]
    roas = round_n(f"{msum('event_revenue_usd')} / NULLIF({msum('af_cost_value')}, 0)", 2)
    return f"""
SELECT campaign, dt, MAX(af_channel) AS media_source, COUNT(1) AS t_events,
  {", ".join(counts)},
  {mround("event_revenue")} AS revenue,
  {mround("af_cost_value")} AS cost,
  {roas} AS roas,
  MAX(data_source) AS data_source
FROM {source}
WHERE {where}
GROUP BY ALL"""


JOB_LOG_SQL = """
job_log AS (
  SELECT o_orderdate AS ts, strftime(o_orderdate, '%Y-%m-%d') AS dt,
    lpad(hex(o_orderkey), 8, '0') AS uid, 'etl' AS username, o_orderpriority AS job_name,
    'daily' AS job_type, 'daily_etl.py' AS file_name,
    CASE o_orderstatus WHEN 'F' THEN 'end' WHEN 'O' THEN 'start' WHEN 'P' THEN 'error' END AS step_name,
    CAST(CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS INTEGER) AS step_id,
    'prod' AS log_type,
    'daily_etl.py proj --etl-name ' || o_orderpriority || ' --etl-action daily --days-back '
      || CAST(o_custkey % 3 AS VARCHAR) AS message
  FROM orders
)"""


def with_ctes(body: str, *ctes: str) -> str:
    """``WITH cte, cte, ... body`` (no adapter)."""
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body
