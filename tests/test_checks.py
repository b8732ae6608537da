import datetime as dt

from pyspark.sql import functions as F

from roasty.operators import checks as C
from roasty.operators import joblog as J
from roasty.schemas import JOB_LOG

D, TS = dt.date, dt.datetime


def _series(spark, values):
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "dt date, dau long")


def test_change_alert_current_value_denominator(spark):
    cases = {(100, 111): False, (100, 89): True, (100, 105): False, (100, 0): True}
    for (a, b), want in cases.items():
        r = C.change_alert(_series(spark, [a, b]), "dt", "dau", 0.1, "dau", "t").collect()
        assert len(r) == 1 and r[0].raise_flag is want, (a, b)
        assert r[0].previous_metric == str(a) and r[0].metric == float(b)
    single = C.change_alert(_series(spark, [100]), "dt", "dau", 0.1, "dau", "t").collect()
    assert single[0].raise_flag is False


def test_change_alert_series_latest_equals_last_of_series(spark):
    s = _series(spark, [10, 20, 15, 30])
    series = C.change_alert(s, "dt", "dau", 0.1, "k", "t", latest_only=False).orderBy("dt").collect()
    latest = C.change_alert(s, "dt", "dau", 0.1, "k", "t").collect()
    assert series[-1] == latest[0] and len(series) == 4


def test_inactive_users_strict(spark):
    up = spark.createDataFrame([("u100", D(2024, 1, 1)), ("u101", D(2023, 12, 31))], "user_id string, last_active_dt date")
    r = C.inactive_users(up, D(2024, 4, 10), days=100).collect()
    assert [x.kpi for x in r] == ["last_active_dt: u101"]
    assert r[0].metric == 101.0 and r[0].previous_metric == "2023-12-31"


def test_reconcile_inner_vs_flag_missing(spark):
    src = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),)], "dt date")
    dst = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 3),)], "dt date")
    one = F.count(F.lit(1))
    inner = C.reconcile_counts(src, dst, "dt", "dt", one, one, "t").collect()
    assert [(r.dt.day, r.raise_flag) for r in inner] == [(1, False)]
    full = C.reconcile_counts(src, dst, "dt", "dt", one, one, "t", missing="flag").orderBy("dt").collect()
    assert [(r.dt.day, r.raise_flag) for r in full] == [(1, False), (2, True), (3, True)]


def test_reconcile_stages_reports_missing_days(spark):
    ev = lambda d: (TS(2024, 1, d, 5),)
    raw_i = spark.createDataFrame([ev(8), ev(9)], "event_time timestamp_ntz")
    raw_a = spark.createDataFrame([ev(9)], "event_time timestamp_ntz")
    fact = spark.createDataFrame([(D(2024, 1, 8),), (D(2024, 1, 9),)], "dt date")
    panel = spark.createDataFrame([(D(2024, 1, 8), 1), (D(2024, 1, 9), 2)], "dt date, t_events long")
    out = C.reconcile_stages(raw_i, raw_a, fact, panel, D(2024, 1, 10), 7).collect()
    assert [(r.dt.day, r.ext_rows, r.fact_rows, r.daily_panel_rows) for r in out] == [(9, 2, 1, 2)]


def test_audit_null_and_blank(spark):
    df = spark.createDataFrame([("x", None), ("  ", "y"), (None, "z")], "a string, b string")
    got = {(r.test_name, r.column_name): r.failures for r in C.column_audit(df, "t", ["a", "b"], ["a", "b"]).collect()}
    assert got == {("not_null", "a"): 1, ("not_null", "b"): 1, ("string_not_empty", "a"): 1, ("string_not_empty", "b"): 0}
    sev = {r.column_name: r.severity for r in C.severity(C.column_audit(df, "t", ["a"]), "failures").collect()}
    assert sev == {"a": "error"}


def test_has_todays_data(spark):
    df = spark.createDataFrame([(TS(2024, 1, 9, 1),), (TS(2024, 1, 10, 1),)], "event_time timestamp_ntz")
    assert C.has_todays_data(df, D(2024, 1, 10)).count() == 0
    r = C.has_todays_data(df, D(2024, 1, 11), table_name="t").collect()
    assert len(r) == 1 and r[0].failures == 2


def test_freshness_whole_hours(spark):
    df = spark.createDataFrame([(TS(2024, 1, 1, 0, 59),)], "ts timestamp_ntz")
    r = C.freshness(df, "ts", TS(2024, 1, 1, 2, 0), 0, "fact", "t").first()
    assert r.metric == 1.0 and r.raise_flag and r.kpi == "fact (hours)"


def _log(spark, rows):
    full = []
    for ts, job, step, msg in rows:
        full.append((ts, ts.strftime("%Y-%m-%d"), "u", "me", job, "daily", "f.py", step, 1, "prod", msg))
    return spark.createDataFrame(full, JOB_LOG)


def test_log_staleness_boundaries_missing_and_negative(spark):
    logs = _log(spark, [(TS(2024, 1, 1, 0, 59), "fact", "end", "f.py p --days-back 1"),
                        (TS(2024, 1, 1, 0, 10), "fact", "end", "f.py p --days-back 1")])
    exp = J.log_expectations(spark, [
        {"alert_name": "a1", "job_type": "daily", "job_name": "fact", "file_name": "f.py", "step_name": "end", "thresh_in_hours": 1},
        {"alert_name": "a2", "job_type": "daily", "job_name": "fact", "file_name": "f.py", "step_name": "end", "thresh_in_hours": -5},
        {"alert_name": "a3", "job_type": "daily", "job_name": "panel", "file_name": "f.py", "step_name": "end", "thresh_in_hours": 24},
        {"alert_name": "a4", "job_type": "daily", "job_name": "fact", "file_name": "f.py", "step_name": "end", "thresh_in_hours": 1, "message": "%nothing%"},
    ])
    r = {x.alert_name: x for x in J.log_staleness(logs, exp, TS(2024, 1, 1, 2, 0)).collect()}
    assert set(r) == {"a1", "a2"}
    assert r["a1"].raise_flag is True  # 2 hour boundaries > 1 (1 whole hour would not be)
    assert r["a1"].ts == TS(2024, 1, 1, 0, 59)
    assert r["a2"].raise_flag is True
    m = {x.alert_name: x.raise_flag for x in J.log_staleness(logs, exp, TS(2024, 1, 1, 2, 0), missing="flag").collect()}
    assert m["a3"] is True and m["a4"] is True


def test_backfill_plan_days(spark):
    today = D(2024, 1, 10)
    flags = spark.createDataFrame(
        [("j0", "daily", "f.py", "f.py p --days-back 1", "2024-01-10"),
         ("j1", "daily", "f.py", "f.py p --days-back 1", "2024-01-09"),
         ("j3", "daily", "f.py", "f.py p --days-back 4", "2024-01-07")],
        "job_name string, job_type string, file_name string, message string, dt string",
    )
    plan = J.order_plan(J.backfill_plan(flags, today)).collect()
    got = [(p.job_name, p.run_date.day, p.command) for p in plan]
    assert got == [
        ("j1", 9, "f.py p --days-back 1"),
        ("j3", 7, "f.py p --days-back 3"),
        ("j3", 8, "f.py p --days-back 2"),
        ("j3", 9, "f.py p --days-back 1"),
    ]


def test_job_logger_and_flag_json(spark, tmp):
    lg = J.JobLogger(spark, f"{tmp}/logs", "fact", "daily", "daily_etl.py", message="daily_etl.py p --days-back 2")
    lg.log("start", TS(2024, 1, 1, 7))
    lg.log("end", TS(2024, 1, 1, 8))
    logs = spark.read.parquet(f"{tmp}/logs")
    assert sorted((r.step_id, r.step_name) for r in logs.collect()) == [(1, "start"), (2, "end")]
    exp = J.log_expectations(spark, [{"alert_name": "a", "job_type": "daily", "job_name": "fact", "file_name": "daily_etl.py", "step_name": "end", "thresh_in_hours": 24}])
    st = J.log_staleness(logs.select(*JOB_LOG.fieldNames()), exp, TS(2024, 1, 3, 8))
    flags = J.flags_for_retry(st)
    assert "message" not in J.alert_rows(flags).columns and "job_name" in J.alert_rows(flags).columns
    J.write_flags(flags, f"{tmp}/flags")
    back = spark.read.json(f"{tmp}/flags").collect()
    assert len(back) == 1 and back[0].message == "daily_etl.py p"
    J.write_flags(flags.where(F.lit(False)), f"{tmp}/none")
    assert spark.read.format("text").load(f"{tmp}/none").count() == 0


def test_run_checks_flagged_only(spark):
    a = C.change_alert(_series(spark, [100, 50]), "dt", "dau", 0.1, "dau", "t")
    b = C.change_alert(_series(spark, [100, 100]), "dt", "dau", 0.1, "dau", "t")
    out = C.run_checks({"a": a, "b": b}).collect()
    assert len(out) == 1 and C.any_flag(a) and not C.any_flag(b)
    assert C.run_checks({"a": a, "b": b}, enabled=["b"]).count() == 0


def test_freshness_reads_only_newest_landing_partitions(spark, tmp):
    from roasty.operators.incremental import partition_values

    rows = [(TS(2024, 1, d, h), f"202401{l:02d}") for d, h, l in
            [(1, 5, 1), (2, 23, 3), (3, 1, 3), (4, 2, 4), (3, 22, 5)]]  # the last is a late row
    spark.createDataFrame(rows, "event_time timestamp_ntz, ymd string").write.partitionBy("ymd").parquet(f"{tmp}/raw")
    raw = spark.read.schema("event_time timestamp_ntz, ymd string").parquet(f"{tmp}/raw")
    top = partition_values(spark, f"{tmp}/raw", "ymd")[-1]
    cut = C.newest_by_landing(raw, "event_time", top)
    assert cut.agg(F.max("event_time")).first()[0] == TS(2024, 1, 4, 2)
    assert sorted(r.ymd for r in cut.select("ymd").distinct().collect()) == ["20240103", "20240104", "20240105"]
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    r = C.freshness(cut, "event_time", TS(2024, 1, 4, 12), 24, "raw", "raw").first()
    assert r.metric == 10.0 and not r.raise_flag
