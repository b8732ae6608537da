"""Config-driven monitoring: the check and log-alert configurations of the
reference's shape, run as DataFrame checks.

A validation config is ``{project: {group: {check_name: {...}}}}``; each
check names its kind in ``sql`` and is skipped unless ``isEnable`` is true.
A log-alert config is ``{group: {"alerts": {alert_name: {...}}}}``. Tables
are looked up by the caller's ``resolve(dataset, table) -> DataFrame``, so
the same config runs against any storage. Measures and keys in the config
(``count(1)``, ``date(event_time)``) are Spark SQL expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roasty.operators import checks as C
from roasty.operators import joblog as J
from roasty.schemas import CHECK_COLUMNS

Resolver = Callable[[str, str], DataFrame]

# The check kinds a validation config can name.
CHECK_KINDS = (
    "row_num_validation",
    "dataset_freshness_alert",
    "gaming_dau_alert",
    "gaming_installs_alert",
    "gaming_last_active_dt_alert",
)


def _table_name(conf: Mapping, dataset_key: str, table_key: str) -> str:
    return f"{conf.get(dataset_key, '')}.{conf[table_key]}".lstrip(".")


def check_from_config(name: str, conf: Mapping, resolve: Resolver, as_of, as_of_ts) -> DataFrame:
    """One configured check as a ``CHECK_RESULT`` frame."""
    kind = conf.get("sql")
    if kind == "row_num_validation":
        src = resolve(conf.get("dataset_src", ""), conf["table_src"])
        dst = resolve(conf.get("dataset_dst", ""), conf["table_dst"])
        key = F.expr(conf["partition_atr"])
        return C.reconcile_counts(
            src, dst, key, key, F.expr(conf["cnt_src"]), F.expr(conf["cnt_dst"]),
            _table_name(conf, "dataset_dst", "table_dst"), date=as_of,
        )
    if kind == "dataset_freshness_alert":
        table = resolve(conf["dataset_id"], conf["table_id"])
        return C.freshness(C.last_modified(table), "ts", as_of_ts, int(conf["thresh_in_hours"]), name,
                           _table_name(conf, "dataset_id", "table_id"))
    if kind in ("gaming_dau_alert", "gaming_installs_alert"):
        table = resolve(conf["dataset"], conf["table_id"])
        d, v = ("dt", "dau") if kind == "gaming_dau_alert" else ("install_dt", "installs")
        return C.change_alert(table, d, v, float(conf["thresh_in_percent"]), name, _table_name(conf, "dataset", "table_id"))
    if kind == "gaming_last_active_dt_alert":
        table = resolve(conf["dataset"], conf["table_id"])
        return C.inactive_users(table, as_of, int(conf["thresh_in_days"]), name, _table_name(conf, "dataset", "table_id"))
    raise ValueError(f"check {name!r}: unknown kind {kind!r} (one of {CHECK_KINDS})")


def run_validation(
    config: Mapping,
    resolve: Resolver,
    as_of,
    as_of_ts,
    group: str | None = None,
    flagged_only: bool = True,
) -> DataFrame:
    """All enabled checks of a validation config (of one group, or all) in
    one union; flagged rows only by default. Entries without a check kind
    (empty placeholders) are skipped."""
    frames = []
    for _project, groups in config.items():
        for gname, checks in groups.items():
            if group is not None and gname != group:
                continue
            for name, conf in checks.items():
                if not isinstance(conf, Mapping) or not conf.get("isEnable") or not conf.get("sql"):
                    continue
                frames.append(check_from_config(name, conf, resolve, as_of, as_of_ts))
    if not frames:
        raise ValueError("no enabled check in the configuration")
    out = reduce(DataFrame.unionByName, [f.select(*CHECK_COLUMNS) for f in frames])
    return out.where(F.col("raise_flag")) if flagged_only else out


def log_alerts_from_config(spark: SparkSession, config: Mapping, job_type: str, group: str | None = None) -> DataFrame:
    """Expectations table from a log-alert config. ``enable_message`` set to
    a comment marker disables the message filter, as in the reference."""
    alerts = []
    for gname, g in config.items():
        if group is not None and gname != group:
            continue
        for name, a in g.get("alerts", {}).items():
            use_message = a.get("enable_message", "--").strip() != "--" and a.get("message")
            alerts.append(
                {
                    "alert_name": name if group is not None else f"{gname}.{name}",
                    "job_type": job_type,
                    "job_name": a["job_name"],
                    "file_name": a["file_name"],
                    "step_name": a["step_name"],
                    "message": a["message"] if use_message else None,
                    "thresh_in_hours": int(a["thresh_in_hours"]),
                }
            )
    return J.log_expectations(spark, alerts)
