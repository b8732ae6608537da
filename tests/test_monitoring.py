import datetime as dt

from pyspark.sql import functions as F

from roasty.operators import joblog as J
from roasty.operators.fact import build_fact
from roasty.operators.panel import campaign_panel
from roasty.plans.monitoring import log_alerts_from_config, run_validation
from roasty.sources import adapters as A

SF = "/root/testdata/sf0.001"
D, TS = dt.date, dt.datetime


def _tables(spark, tmp):
    inst, app = A.feeds(spark, SF)
    fact = build_fact(inst, app, tag=False)
    fact.write.parquet(f"{tmp}/fact")
    return {
        ("ds", "raw"): inst.unionByName(app, allowMissingColumns=True),
        ("ds", "fact"): spark.read.parquet(f"{tmp}/fact"),
        ("ds", "panel"): campaign_panel(fact, by_install=True),
        ("p", "dau"): A.dau(spark, SF),
        ("p", "installs"): A.installs_daily(spark, SF),
        ("p", "user_panel"): A.user_panel(spark, SF),
    }


CONFIG = {
    "proj": {
        "validation": {
            "fact_validation": {
                "dataset_src": "ds", "table_src": "raw", "dataset_dst": "ds", "table_dst": "fact",
                "partition_atr": "date(event_time)", "cnt_src": "count(1)", "cnt_dst": "count(1)",
                "isEnable": True, "sql": "row_num_validation",
            },
            "panel_validation": {
                "dataset_src": "ds", "table_src": "fact", "dataset_dst": "ds", "table_dst": "panel",
                "partition_atr": "dt", "cnt_src": "count(1)", "cnt_dst": "sum(t_events)",
                "isEnable": True, "sql": "row_num_validation",
            },
            "fact_freshness": {"dataset_id": "ds", "table_id": "fact", "thresh_in_hours": 24,
                               "isEnable": True, "sql": "dataset_freshness_alert"},
            "disabled": {"dataset_id": "ds", "table_id": "fact", "thresh_in_hours": 24,
                         "isEnable": False, "sql": "dataset_freshness_alert"},
        },
        "kpis": {
            "": {"": ""},
            "dau": {"dataset": "p", "table_id": "dau", "thresh_in_percent": 0.1, "isEnable": True, "sql": "gaming_dau_alert"},
            "installs": {"dataset": "p", "table_id": "installs", "thresh_in_percent": 0.1, "isEnable": True,
                         "sql": "gaming_installs_alert"},
            "last_active_dt": {"dataset": "p", "table_id": "user_panel", "thresh_in_days": 0, "isEnable": True,
                               "sql": "gaming_last_active_dt_alert"},
        },
    }
}


def test_run_validation_all_groups(spark, tmp):
    tables = _tables(spark, tmp)
    out = run_validation(CONFIG, lambda d, t: tables[(d, t)], D(2024, 1, 30), TS(2024, 1, 31, 6), flagged_only=False)
    rows = out.collect()
    kpis = sorted({r.kpi.split(":")[0] for r in rows})
    assert kpis == ["dau", "fact_freshness (hours)", "installs", "last_active_dt", "row_num"]
    recon = [r for r in rows if r.kpi == "row_num"]
    assert len(recon) == 2 and not any(r.raise_flag for r in recon)  # both stages agree on the 30th
    fresh = [r for r in rows if r.kpi.startswith("fact_freshness")][0]
    assert not fresh.raise_flag and fresh.metric < 0  # written after that as-of time
    later = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) + dt.timedelta(hours=48)
    flagged = run_validation(CONFIG, lambda d, t: tables[(d, t)], D(2024, 1, 30), later, group="validation").collect()
    assert [r.kpi for r in flagged] == ["fact_freshness (hours)"]
    only_kpis = run_validation(CONFIG, lambda d, t: tables[(d, t)], D(2024, 1, 30), TS(2024, 1, 31, 6), group="kpis",
                               flagged_only=False)
    assert {r.table_name for r in only_kpis.collect()} == {"p.dau", "p.installs", "p.user_panel"}


def test_log_alerts_from_config(spark):
    config = {
        "etl": {"alerts": {
            "a_end": {"message": "", "enable_message": "--", "step_name": "end", "file_name": "daily_etl.py",
                      "job_name": "1-URGENT", "thresh_in_hours": 24},
            "a_msg": {"message": "%--days-back 2", "enable_message": "", "step_name": "end",
                      "file_name": "daily_etl.py", "job_name": "5-LOW", "thresh_in_hours": 24},
        }}
    }
    exp = log_alerts_from_config(spark, config, "daily")
    got = {r.alert_name: r.message for r in exp.collect()}
    assert got == {"etl.a_end": None, "etl.a_msg": "%--days-back 2"}
    st = J.log_staleness(A.job_log(spark, SF), exp, TS(2001, 8, 1, 12)).collect()
    assert {r.alert_name for r in st} <= {"etl.a_end", "etl.a_msg"}
    assert all(r.message.endswith("--days-back 2") for r in st if r.alert_name == "etl.a_msg")


def test_command_line_checks_logs_and_plan(spark, tmp):
    import json

    from roasty.__main__ import main

    tables = _tables(spark, tmp)
    paths = {}
    for (d, t), df in tables.items():
        paths[f"{d}.{t}"] = f"{tmp}/tables/{d}.{t}"
        df.write.parquet(paths[f"{d}.{t}"])
    for name, obj in (("validation.json", CONFIG), ("tables.json", paths)):
        with open(f"{tmp}/{name}", "w") as fh:
            json.dump(obj, fh)
    assert main(["checks", "--validation", f"{tmp}/validation.json", "--tables", f"{tmp}/tables.json",
                 "--out", f"{tmp}/flags", "--group", "kpis", "--as-of", "2024-01-30"], spark=spark) == 0
    flagged = spark.read.json(f"{tmp}/flags").collect()
    assert flagged and all(r.raise_flag for r in flagged)

    A.job_log(spark, SF).write.parquet(f"{tmp}/log")
    log_config = {"etl": {"alerts": {"a": {"message": "", "enable_message": "--", "step_name": "end",
                                           "file_name": "daily_etl.py", "job_name": "1-URGENT", "thresh_in_hours": 24}}}}
    with open(f"{tmp}/logs.json", "w") as fh:
        json.dump(log_config, fh)
    assert main(["logs", "--log-config", f"{tmp}/logs.json", "--logs", f"{tmp}/log", "--out", f"{tmp}/lflags",
                 "--as-of-ts", "2001-08-03T12:00:00"], spark=spark) == 0
    lf = spark.read.json(f"{tmp}/lflags").collect()
    assert len(lf) == 1 and "--days-back" not in lf[0].message
    assert main(["plan", "--flags", f"{tmp}/lflags", "--out", f"{tmp}/plan", "--as-of", "2001-08-03",
                 "--log-path", f"{tmp}/runlog"], spark=spark) == 0
    assert [r.step_name for r in spark.read.parquet(f"{tmp}/runlog").orderBy("step_id").collect()] == ["start", "end"]
    plan = sorted(r.command for r in spark.read.json(f"{tmp}/plan").collect())
    missed = (D(2001, 8, 3) - D.fromisoformat(lf[0].dt)).days  # from the last good day to yesterday
    assert len(plan) == missed and plan[0].endswith("--days-back 1")
