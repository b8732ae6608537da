import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from roasty.operators.fact import build_fact
from roasty.operators.panel import campaign_panel
from roasty.plans.daily import Layout, backfill, run_daily
from roasty.schemas import FEEDS, INSTALLS, PANEL_BY_INSTALL
from roasty.sources import adapters as A
from roasty.sources import landing as L
from roasty.streaming.ingest import ingest_available

SF = "/root/testdata/sf0.001"


def _write_landing(spark, root, feed_df, feed):
    """Write a derived feed as one CSV per landing day (test input only)."""
    pdf = feed_df.toPandas()
    for ymd, part in pdf.groupby("ymd"):
        os.makedirs(f"{root}/{ymd}", exist_ok=True)
        part.drop(columns=["ymd"]).to_csv(f"{root}/{ymd}/{feed}.csv", index=False)


@pytest.fixture(scope="module")
def landing_root(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    inst, app = A.feeds(spark, SF)
    _write_landing(spark, root, inst, "installs")
    _write_landing(spark, root, app, "inapp")
    return root


def test_infer_format_and_table_name():
    assert L.infer_format("a/b/x.NDJSON") == "json"
    assert L.infer_format("x.orc") == "orc"
    with pytest.raises(ValueError, match="xlsx"):
        L.infer_format("report.xlsx")
    assert L.table_name_of("landing/20240101/vendor-installs data.csv") == "vendor_installs_data"


def test_csv_json_field_round_trip(spark, tmp):
    p = f"{tmp}/20240105/installs.csv"
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as fh:
        fh.write(",".join(INSTALLS.fieldNames()) + "\n")
        fh.write('2024-01-05 10:00:00,2024-01-05 10:00:00,install,0.0,"{""a"": 1, ""b"": ""0""}",0.0,CPI,1.5,USD,'
                 "SDK,facebook_int,Facebook,,itunes,c1,US,ios,1.5.1,app,id1\n")
    r = L.read_landing(spark, p, schema=INSTALLS).first()
    assert r.event_value == '{"a": 1, "b": "0"}' and r.af_cost_value == 1.5 and r.ymd == "20240105"
    assert r.event_time == dt.datetime(2024, 1, 5, 10)


def test_empty_day_gives_declared_schema(spark, tmp):
    df = L.read_feed(spark, tmp, "installs.csv", INSTALLS, days=["20240101"])
    assert df.count() == 0 and df.columns == INSTALLS.fieldNames() + ["ymd"]


def test_parquet_json_orc_readers_align_by_name(spark, tmp):
    inst, _ = A.feeds(spark, SF)
    src = inst.where(F.col("ymd") == "20240101").drop("ymd")
    n = src.count()
    for fmt in ("parquet", "orc", "json"):
        out = f"{tmp}/{fmt}/20240101/installs.{fmt}"
        src.select(*reversed(src.columns)).write.format(fmt).save(out)
        df = L.read_landing(spark, out, schema=INSTALLS)
        assert df.count() == n and df.columns[:20] == INSTALLS.fieldNames(), fmt
        assert df.where(F.col("ymd") == "20240101").count() == n


def test_avro_missing_gives_clear_error(spark, tmp):
    os.makedirs(f"{tmp}/20240101")
    open(f"{tmp}/20240101/x.avro", "wb").write(b"not avro")
    try:
        L.read_landing(spark, f"{tmp}/20240101/x.avro", schema=INSTALLS).count()
    except RuntimeError as e:
        assert "spark-avro" in str(e)
    except Exception:
        pass  # the package is present: the bad file itself fails


def test_load_raw_is_idempotent(spark, landing_root, tmp):
    raw = f"{tmp}/raw/installs"
    days = ["20240101", "20240102"]
    L.load_raw(L.read_feed(spark, landing_root, "installs.csv", INSTALLS, days=days), raw)
    n1 = L.read_raw(spark, raw, INSTALLS).count()
    L.load_raw(L.read_feed(spark, landing_root, "installs.csv", INSTALLS, days=days[1:]), raw)
    assert L.read_raw(spark, raw, INSTALLS).count() == n1
    assert L.read_raw(spark, raw, INSTALLS, from_ymd="20240102").select("ymd").distinct().count() == 1


def _expected_panel(spark):
    inst, app = A.feeds(spark, SF)
    return campaign_panel(build_fact(inst, app, tag=False), by_install=True)


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*PANEL_BY_INSTALL.fieldNames()).collect())


def test_backfill_then_daily_reruns_are_stable(spark, landing_root, tmp):
    lay = Layout(landing_root, f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel")
    start = backfill(spark, lay, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    assert start == dt.date(2024, 1, 1)
    want = _rows(_expected_panel(spark))
    assert _rows(spark.read.parquet(lay.panel_path)) == want
    # The daily action for the 30th, twice: the late rows of the 29th are
    # rewritten, not duplicated, and nothing else changes.
    run_daily(spark, lay, dt.date(2024, 1, 31), days_back=1)
    run_daily(spark, lay, dt.date(2024, 1, 31), days_back=1)
    assert _rows(spark.read.parquet(lay.panel_path)) == want
    assert spark.read.parquet(lay.fact_path).count() == A.read_table(spark, SF, "events").count()
    from roasty.plans.daily import read_fact, read_panel
    from roasty.schemas import FACT_TAGGED

    assert read_panel(spark, lay).columns == PANEL_BY_INSTALL.fieldNames()  # dt in its declared place
    assert read_fact(spark, lay).columns == FACT_TAGGED.fieldNames()


def test_streaming_ingest_matches_batch_load(spark, landing_root, tmp):
    raw_s = f"{tmp}/stream_raw"
    ingest_available(spark, landing_root, "inapp.csv", FEEDS["inapp"], raw_s, f"{tmp}/ckpt")
    again = ingest_available(spark, landing_root, "inapp.csv", FEEDS["inapp"], raw_s, f"{tmp}/ckpt")
    assert again.lastProgress is None or again.lastProgress["numInputRows"] == 0
    raw_b = f"{tmp}/batch_raw"
    L.load_raw(L.read_feed(spark, landing_root, "inapp.csv", FEEDS["inapp"]), raw_b)
    s = L.read_raw(spark, raw_s, FEEDS["inapp"])
    b = L.read_raw(spark, raw_b, FEEDS["inapp"])
    assert s.count() == b.count() and s.exceptAll(b).count() == 0


def test_csv_schema_inference_option(spark, tmp):
    p = f"{tmp}/20240105/small.csv"
    os.makedirs(os.path.dirname(p))
    with open(p, "w") as fh:
        fh.write("a,b,c\n1,2.5,\n2,3.5,\n")
    df = L.read_landing(spark, p, infer=True)
    types = dict(df.dtypes)
    assert types["a"] == "int" and types["b"] == "double" and types["c"] == "string"  # all-empty -> string


def test_external_view(spark, landing_root):
    L.register_external(spark, "ext_installs", f"{landing_root}/*/installs.csv", schema=INSTALLS)
    n = spark.sql("SELECT COUNT(*) AS n FROM ext_installs").first().n
    assert n == A.installs_feed(A.read_table(spark, SF, "events")).count()


def test_last_modified_of_raw_table(spark, landing_root, tmp):
    from roasty.operators.checks import freshness, last_modified

    raw = f"{tmp}/raw_lm"
    L.load_raw(L.read_feed(spark, landing_root, "installs.csv", INSTALLS, days=["20240101"]), raw)
    lm = last_modified(spark.read.parquet(raw))
    ts = lm.first().ts
    assert ts is not None and abs((dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - ts).total_seconds()) < 3600
    r = freshness(lm, "ts", ts + dt.timedelta(hours=30), 24, "raw freshness", "raw.installs").first()
    assert r.raise_flag and r.metric == 30.0


def test_load_day_by_file_name(spark, landing_root, tmp):
    loaded = L.load_day_by_file(spark, landing_root, "20240102", f"{tmp}/raw_by_name", schemas={"installs": INSTALLS})
    assert set(loaded) == {"installs", "inapp"}
    inst = L.read_raw(spark, loaded["installs"], INSTALLS)
    assert inst.count() > 0 and inst.select("ymd").distinct().first().ymd == "20240102"
    assert dict(spark.read.parquet(loaded["inapp"]).dtypes)["event_revenue"] == "double"  # inferred
    assert L.load_day_by_file(spark, landing_root, "20990101", f"{tmp}/raw_by_name") == {}


def test_load_day_rejects_unknown_extension(spark, tmp):
    os.makedirs(f"{tmp}/20240101")
    open(f"{tmp}/20240101/report.xlsx", "w").write("x")
    with pytest.raises(ValueError, match="xlsx"):
        L.load_day_by_file(spark, tmp, "20240101", f"{tmp}/raw")


def test_scheduled_ingest_and_sql_views(spark, landing_root, tmp):
    from roasty.plans.views import register_views
    from roasty.streaming.ingest import start_ingest

    q = start_ingest(spark, landing_root, "installs.csv", INSTALLS, f"{tmp}/raw/installs", f"{tmp}/ck", every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    lay = Layout(landing_root, f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel")
    assert register_views(spark, lay) == ["raw_installs", "raw_inapp"]
    n = spark.sql("SELECT COUNT(*) AS n FROM raw_installs").first().n
    assert n == A.installs_feed(A.read_table(spark, SF, "events")).count()
    # The panel as the reference writes it, in Spark SQL (GROUP BY ALL), over
    # the fact built by the library.
    build_fact(A.installs_feed(A.read_table(spark, SF, "events")), A.inapp_feed(A.read_table(spark, SF, "events")),
               tag=False).createOrReplaceTempView("fact")
    sql_panel = spark.sql("""
        SELECT campaign, dt, MAX(af_channel) AS media_source,
          CASE WHEN event_name = 'install' THEN event_name ELSE 'non_install' END AS is_install,
          COUNT(1) AS t_events,
          SUM(CASE WHEN event_name = 'install' THEN 1 END) AS t_installs,
          SUM(CASE WHEN platform = 'ios' THEN 1 END) AS t_ios_users
        FROM fact GROUP BY ALL""")
    lib = {(r.campaign, r.dt, r.is_install): r for r in _expected_panel(spark).collect()}
    for r in sql_panel.collect():
        p = lib[(r.campaign, r.dt, r.is_install)]
        assert (p.media_source, p.t_events, p.t_installs, p.t_ios_users) == (r.media_source, r.t_events, r.t_installs, r.t_ios_users)


def test_lookback_run_and_late_modes_on_disk(spark, landing_root, tmp):
    from roasty.operators.joblog import JobLogger
    from roasty.plans.daily import read_fact, read_panel, run_lookback

    lay = Layout(landing_root, f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel", by_install=False)
    backfill(spark, lay, dt.date(2024, 1, 1), dt.date(2024, 1, 31))
    before = sorted(tuple(map(str, r)) for r in read_panel(spark, lay).collect())
    log = JobLogger(spark, f"{tmp}/log", "fact", "daily", "daily_etl.py")
    run_lookback(spark, lay, dt.date(2024, 1, 30), 7, logger=log)
    assert sorted(tuple(map(str, r)) for r in read_panel(spark, lay).collect()) == before
    steps = [r.step_name for r in spark.read.parquet(f"{tmp}/log").orderBy("step_id").collect()]
    assert steps == ["start", "success", "end"]
    from roasty.plans.views import register_views

    assert register_views(spark, lay, panel_view="af_daily_panel")[-2:] == ["fact", "af_daily_panel"]
    assert spark.sql("SELECT SUM(t_events) AS n FROM af_daily_panel").first().n == spark.table("fact").count()
    n = read_fact(spark, lay).count()
    # drop: the late rows of the 29th that landed on the 30th are left out of
    # the refresh, but the 29th itself is outside the window and kept as is.
    run_daily(spark, lay, dt.date(2024, 1, 31), days_back=1, late="drop")
    assert read_fact(spark, lay).count() == n
    with pytest.raises(Exception, match="before the refresh window"):
        run_daily(spark, lay, dt.date(2024, 1, 31), days_back=1, late="reject")


def test_run_jobs_from_job_config(spark, landing_root, tmp):
    from roasty.plans.daily import load_landing, read_panel, run_jobs, _days

    config = {"etl_jobs": {
        "fact": {"init": {"enabled": True, "sql": "fact_init"}, "daily": {"enabled": True, "sql": "fact_daily"},
                 "hourly": {"enabled": False, "sql": "fact_hourly"}},
        "daily_panel": {"init": {"enabled": True, "sql": "daily_panel_init"},
                        "daily": {"enabled": True, "sql": "daily_panel_daily"}},
    }}
    lay = Layout(landing_root, f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel")
    load_landing(spark, lay, _days(dt.date(2024, 1, 1), dt.date(2024, 1, 31)))
    assert run_jobs(spark, lay, config, "init", dt.date(2024, 1, 1), days_back=0) == ["fact_init", "daily_panel_init"]
    assert read_panel(spark, lay).count() == 0
    assert run_jobs(spark, lay, config, "hourly", dt.date(2024, 1, 1)) == []
    assert run_jobs(spark, lay, config, "daily", dt.date(2024, 1, 2), days_back=1) == ["fact_daily", "daily_panel_daily"]
    assert _rows(read_panel(spark, lay)) == _rows(_expected_panel(spark))


def test_command_line_daily_and_backfill_plan_command(spark, landing_root, tmp):
    import json

    from roasty.__main__ import main
    from roasty.operators import joblog as J
    from roasty.plans.daily import read_panel

    conf = {"landing_root": landing_root, "raw_root": f"{tmp}/raw", "fact_path": f"{tmp}/fact",
            "panel_path": f"{tmp}/panel", "log_path": f"{tmp}/log"}
    path = f"{tmp}/layout.json"
    with open(path, "w") as fh:
        json.dump(conf, fh)
    assert main(["backfill", "--layout", path, "--first", "2024-01-01", "--last", "2024-01-31"], spark=spark) == 0
    assert main(["daily", "--layout", path, "--as-of", "2024-01-31", "--days-back", "1"], spark=spark) == 0
    assert _rows(read_panel(spark, Layout(landing_root, f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel"))) == _rows(
        _expected_panel(spark))
    logs = spark.read.parquet(f"{tmp}/log").select(*J.JOB_LOG.fieldNames())
    daily_end = logs.where((F.col("job_type") == "daily") & (F.col("step_name") == "end")).first()
    assert daily_end.message == f"python -m roasty daily --layout {path} --days-back 1"
    flags = logs.where(F.col("job_type") == "daily").withColumn("dt", F.lit("2024-01-29")).where("step_name = 'end'")
    plan = J.order_plan(J.backfill_plan(flags, dt.date(2024, 1, 31))).collect()
    assert [p.command for p in plan] == [
        f"python -m roasty daily --layout {path} --days-back 2",
        f"python -m roasty daily --layout {path} --days-back 1",
    ]


def test_run_loader_daily_and_hourly(spark, landing_root, tmp):
    import shutil

    from roasty.plans.daily import run_loader

    root = f"{tmp}/landing"
    shutil.copytree(landing_root, f"{root}/vendor")  # {root}/{etl_name}/{ymd}/{table}.csv
    config = {"loader": {"vendor": {"daily": {"enabled": True, "dataset_id": "raw_ds"},
                                    "hourly": {"enabled": True, "dataset_id": "raw_ds"},
                                    "weekly": {"enabled": False}}}}
    daily = run_loader(spark, config, "vendor", "daily", root, f"{tmp}/raw", dt.date(2024, 1, 3),
                       schemas={"installs": INSTALLS, "inapp": FEEDS["inapp"]})
    assert set(daily) == {"installs", "inapp"}
    n_day = L.read_raw(spark, daily["installs"], INSTALLS).count()
    hourly = run_loader(spark, config, "vendor", "hourly", root, f"{tmp}/raw_h", None,
                        schemas={"installs": INSTALLS}, checkpoint_root=f"{tmp}/ck")
    n_all = L.read_raw(spark, hourly["installs"], INSTALLS).count()
    assert n_all == A.installs_feed(A.read_table(spark, SF, "events")).count() and n_all > n_day > 0
    assert run_loader(spark, config, "vendor", "weekly", root, f"{tmp}/raw", dt.date(2024, 1, 3)) == {}
    from roasty.operators.joblog import JobLogger

    log = JobLogger(spark, f"{tmp}/log", "vendor", "daily", "roasty")
    run_loader(spark, config, "vendor", "daily", root, f"{tmp}/raw", dt.date(2024, 1, 4), logger=log)
    assert [r.step_name for r in spark.read.parquet(f"{tmp}/log").orderBy("step_id").collect()] == ["start", "end"]


def test_parquet_missing_column_is_null_and_raw_reads_prune(spark, tmp):
    inst, _ = A.feeds(spark, SF)
    src = inst.where(F.col("ymd") == "20240101").drop("ymd", "appsflyer_id")
    out = f"{tmp}/20240101/installs.parquet"
    src.write.parquet(out)
    df = L.read_landing(spark, out, schema=INSTALLS)
    assert df.where(F.col("appsflyer_id").isNotNull()).count() == 0 and df.count() == src.count()
    L.load_raw(df, f"{tmp}/raw")
    plan = L.read_raw(spark, f"{tmp}/raw", INSTALLS, from_ymd="20240101")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ymd" in plan and "20240101" in plan


def test_run_jobs_logs_like_the_runner(spark, landing_root, tmp):
    from roasty.operators.joblog import JobLogger
    from roasty.plans.daily import load_landing, run_jobs, _days

    config = {"etl_jobs": {
        "fact": {"daily": {"enabled": True, "sql": "fact_daily"}, "hourly": {"enabled": False, "sql": "x"}},
        "extra": {"daily": {"enabled": True, "sql": "no_such_step"}},
        "noop": {"daily": {"enabled": True}},
        "daily_panel": {"daily": {"enabled": True, "sql": "daily_panel_daily"}},
    }}
    lay = Layout(landing_root, f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel")
    load_landing(spark, lay, _days(dt.date(2024, 1, 1), dt.date(2024, 1, 31)))

    def logger_for(job):
        return JobLogger(spark, f"{tmp}/log", job, "daily", "roasty")

    assert run_jobs(spark, lay, config, "daily", dt.date(2024, 1, 2), logger_for=logger_for) == [
        "fact_daily", "daily_panel_daily"]
    assert run_jobs(spark, lay, config, "hourly", dt.date(2024, 1, 2), jobs=["fact"], logger_for=logger_for) == []
    logs = spark.read.parquet(f"{tmp}/log")
    steps = {}
    for r in logs.orderBy("step_id").collect():
        steps.setdefault(r.job_name, []).append(r.step_name)
    assert steps["extra"] == ["start", "sql_not_found"]
    assert steps["noop"] == ["start", "end"]
    assert steps["daily_panel"] == ["start", "success", "end"]
    assert "skipped" in steps["fact"]


def test_stream_ingest_keeps_whole_days_when_files_arrive_apart(spark, tmp):
    from roasty.streaming.ingest import ingest_available

    inst, _ = A.feeds(spark, SF)
    day = inst.where(F.col("ymd") == "20240105").drop("ymd").toPandas()
    half = len(day) // 2
    os.makedirs(f"{tmp}/landing/20240105")
    day.iloc[:half].to_csv(f"{tmp}/landing/20240105/part-1.csv", index=False)
    ingest_available(spark, f"{tmp}/landing", "*.csv", INSTALLS, f"{tmp}/raw", f"{tmp}/ck")
    assert L.read_raw(spark, f"{tmp}/raw", INSTALLS).count() == half
    day.iloc[half:].to_csv(f"{tmp}/landing/20240105/part-2.csv", index=False)  # a later file of the same day
    ingest_available(spark, f"{tmp}/landing", "*.csv", INSTALLS, f"{tmp}/raw", f"{tmp}/ck")
    assert L.read_raw(spark, f"{tmp}/raw", INSTALLS).count() == len(day)


def test_stream_ingest_under_a_root_with_spaces(spark, tmp):
    from roasty.streaming.ingest import ingest_available

    inst, _ = A.feeds(spark, SF)
    day = inst.where(F.col("ymd") == "20240106").drop("ymd").toPandas()
    root = f"{tmp}/my landing"
    os.makedirs(f"{root}/20240106")
    day.iloc[:3].to_csv(f"{root}/20240106/a.csv", index=False)
    ingest_available(spark, root, "*.csv", INSTALLS, f"{tmp}/raw", f"{tmp}/ck")
    day.iloc[3:].to_csv(f"{root}/20240106/b.csv", index=False)
    ingest_available(spark, root, "*.csv", INSTALLS, f"{tmp}/raw", f"{tmp}/ck")
    assert L.read_raw(spark, f"{tmp}/raw", INSTALLS).count() == len(day)


def test_first_run_on_an_empty_day(spark, tmp):
    from roasty.plans.daily import read_fact, read_panel

    lay = Layout(f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel")
    run_daily(spark, lay, dt.date(2024, 1, 10), days_back=1)  # no landing file, no table yet
    assert read_fact(spark, lay).count() == 0 and read_panel(spark, lay).count() == 0
