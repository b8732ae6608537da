"""Manifests, partial panels, profiles, the job log as a table, contracts,
files by shape and tables named after files."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from roasty.functions.aggregates import ratio
from roasty.functions.dates import timestamp_millis
from roasty.operators import checks as C
from roasty.operators import fact as fact_ops
from roasty.operators import incremental as inc
from roasty.operators import joblog as J
from roasty.operators import profiles as P
from roasty.operators import upstream as U
from roasty.plans import catalog
from roasty.plans import daily as chain
from roasty.schemas import FACT_KEYS, FACT_LANDED, INAPP, INSTALLS, JOB_LOG
from roasty.sources import files as FL
from roasty.sources import landing as L
from roasty.sources import shapes as SH
from roasty.sources import tables as TB
from roasty.streaming.ingest import ingest_available

from test_loading import at, feed


def put(path, text, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    if age:
        os.utime(path, (time.time() - age, time.time() - age))


def row(day, name="x"):
    return f"2024-01-{day:02d} 10:00:00,{name}\n"


HEAD = "event_time,event_name\n"


# Refreshes by landing day.


def test_expired_raw_of_one_feed_keeps_its_fact_rows(spark, tmp):
    lay = chain.Layout(f"{tmp}/l", f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel")
    days = range(1, 11)
    L.load_raw(feed(spark, INSTALLS, [{"event_time": at(d), "event_name": "install", "ymd": f"202401{d:02d}"} for d in days]), lay.raw_path("installs"))
    app = [{"event_time": at(d), "event_name": f"e{d}", "ymd": f"202401{d:02d}"} for d in days]
    L.load_raw(feed(spark, INAPP, app), lay.raw_path("inapp"))
    chain.refresh_fact_on_disk(spark, lay, dt.date(2024, 1, 1))
    inc.expire_partitions(spark, lay.raw_path("inapp"), "ymd", dt.date(2024, 1, 12), days=5)
    L.load_raw(feed(spark, INAPP, [{"event_time": at(2), "event_name": "late", "ymd": "20240111"}]), lay.raw_path("inapp"))
    for first in (11, 11, 1):
        chain.refresh_fact_on_disk(spark, lay, dt.date(2024, 1, first))
        fact = chain.read_fact(spark, lay)
        assert fact.count() == 21 and fact.where("dt = '2024-01-02'").count() == 3
    # A day delivered again without rows is empty, expired or not.
    chain.refresh_fact_on_disk(spark, lay, dt.date(2024, 1, 1), delivered=["20240103"])
    assert chain.read_fact(spark, lay).where("dt = '2024-01-03' AND data_source = 'inapp'").count() == 0
    assert chain.read_fact(spark, lay, landed=True).columns == FACT_LANDED.fieldNames()


@pytest.mark.parametrize("late", ["widen", "drop", "reject"])
def test_refresh_by_landing_equals_the_one_on_disk(spark, tmp, late):
    lay = chain.Layout(f"{tmp}/l", f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel")
    rows = [{"event_time": at(9), "event_name": "a", "ymd": "20240109"}, {"event_time": None, "event_name": "n", "ymd": "20240109"},
            {"event_time": None, "event_name": "n", "ymd": "20240110"}, {"event_time": at(10), "event_name": "b", "ymd": "20240110"}]
    if late != "reject":
        rows.append({"event_time": at(3), "event_name": "late", "ymd": "20240110"})
    none = feed(spark, INSTALLS, [])
    old, new = feed(spark, INAPP, rows[:2]), feed(spark, INAPP, rows)
    L.load_raw(none, lay.raw_path("installs"))
    L.load_raw(old, lay.raw_path("inapp"))
    chain.refresh_fact_on_disk(spark, lay, dt.date(2024, 1, 9))
    L.load_raw(new, lay.raw_path("inapp"))
    target = fact_ops.build_fact(none, old, landing_key="ymd")
    for _ in range(2):
        chain.refresh_fact_on_disk(spark, lay, dt.date(2024, 1, 10), late=late)
        target = fact_ops.refresh_fact(target, none, new, dt.date(2024, 1, 10), late=late)
    key = lambda df: sorted((str(r.dt), r.event_name, r.landed) for r in df.collect())
    assert key(target) == key(chain.read_fact(spark, lay, landed=True))
    assert len(key(target)) == (5 if late == "widen" else 4)


def test_reject_fails_on_a_late_row(spark):
    none = feed(spark, INSTALLS, [])
    late = feed(spark, INAPP, [{"event_time": at(3), "event_name": "late", "ymd": "20240110"}])
    target = fact_ops.build_fact(none, late.where("false"), landing_key="ymd")
    with pytest.raises(Exception, match="before the refresh window"):
        fact_ops.refresh_fact(target, none, late, dt.date(2024, 1, 10), late="reject").collect()


def test_a_fact_of_another_layout_is_refused(spark, tmp):
    fact = fact_ops.build_fact(feed(spark, INSTALLS, []), feed(spark, INAPP, [{"event_time": at(3), "event_name": "x", "ymd": "20240103"}]))
    inc.commit_full(fact, f"{tmp}/fact", "dt")
    with pytest.raises(ValueError, match="rebuild it"):
        inc.pieces(spark, f"{tmp}/fact", FACT_KEYS)


def test_ratios_round_once(spark):
    rows = [("502.83", "6", 83.81), ("-502.83", "6", -83.81), ("0.004999999999999999", "1", 0.0), ("1", "0", None), (None, "2", None),
            ("10000000000000000000", "3", 3333333333333333333.33), ("2", None, None), ("0", "5", 0.0)]
    df = spark.createDataFrame([(n, d) for n, d, _ in rows], "n string, d string").select(*[F.col(c).cast("decimal(38,18)") for c in "nd"])
    assert [r[0] for r in df.select(ratio(F.col("n"), F.col("d"))).collect()] == [w for *_, w in rows]


# Files.


def test_file_table_and_changes(spark, tmp):
    put(f"{tmp}/in/20240101/a.csv", HEAD + row(1), age=7200)
    put(f"{tmp}/in/20240101/_skip.csv", "x")
    put(f"{tmp}/in/20240102/a.csv", HEAD)
    now = FL.file_table(spark, f"{tmp}/in")
    got = {(r.ymd, r.name): r for r in now.collect()}
    assert set(got) == {("20240101", "a.csv"), ("20240102", "a.csv")}
    first = got["20240101", "a.csv"]
    assert first.n_bytes == len(HEAD + row(1)) and abs(first.modified_ms / 1000 - (time.time() - 7200)) < 60
    assert first.modified == dt.datetime(1970, 1, 1) + dt.timedelta(milliseconds=first.modified_ms)
    assert FL.file_table(spark, f"{tmp}/none").count() == 0
    assert C.modified_at(spark, f"{tmp}/in") == got["20240102", "a.csv"].modified and C.modified_at(spark, f"{tmp}/none") is None
    before = now.select("path", "n_bytes", "modified_ms", "ymd").collect()
    before = spark.createDataFrame([*before, ("gone", 1, 1, "20231231")], "path string, n_bytes long, modified_ms long, ymd string")
    put(f"{tmp}/in/20240101/a.csv", HEAD + row(1) + row(1))
    put(f"{tmp}/in/20240103/b.csv", HEAD)
    changes = FL.file_changes(FL.file_table(spark, f"{tmp}/in"), before)
    assert sorted((r.ymd, r.change) for r in changes.collect()) == [("20231231", "gone"), ("20240101", "replaced"), ("20240103", "new")]


def test_millis_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([(0,), (1_706_659_200_123,), (None,)], "ms long").select(timestamp_millis("ms").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert [r.t for r in df.collect()] == [dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 31, 0, 0, 0, 123000), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_sync_reloads_changed_days_only(spark, tmp):
    root, raw, known = f"{tmp}/in", f"{tmp}/raw", f"{tmp}/known"
    for d in (1, 2, 3):
        put(f"{root}/2024010{d}/inapp.csv", HEAD + row(d), age=100)
    sync = lambda: FL.sync_landing(spark, root, "inapp.csv", INAPP, raw, known)
    assert sync() == ["20240101", "20240102", "20240103"] and sync() == []
    put(f"{root}/20240102/inapp.csv", HEAD + row(2, "new") + row(2, "more"))
    os.remove(f"{root}/20240103/inapp.csv")
    stamps = {p: os.stat(f"{raw}/ymd=20240101/{p}").st_mtime_ns for p in os.listdir(f"{raw}/ymd=20240101")}
    assert sync() == ["20240102", "20240103"] and sync() == []
    assert sorted((r.ymd, r.event_name) for r in L.read_raw(spark, raw, INAPP).collect()) == [("20240101", "x"), ("20240102", "more"), ("20240102", "new")]
    assert stamps == {p: os.stat(f"{raw}/ymd=20240101/{p}").st_mtime_ns for p in os.listdir(f"{raw}/ymd=20240101")}


def test_stream_with_a_manifest(spark, tmp):
    root, raw = f"{tmp}/in", f"{tmp}/raw"
    run = lambda: ingest_available(spark, root, "inapp.csv", INAPP, raw, f"{tmp}/state", manifest=f"{tmp}/known")
    names = lambda: sorted(r.event_name for r in L.read_raw(spark, raw, INAPP).collect())
    put(f"{root}/20240101/inapp.csv", HEAD + row(1, "a"), age=100)
    run()
    put(f"{root}/20240101/inapp.csv", HEAD + row(1, "b"))
    put(f"{root}/20240102/inapp.csv", HEAD + row(2, "c"))
    run()
    assert names() == ["b", "c"]
    os.remove(f"{root}/20240101/inapp.csv")
    run()
    assert names() == ["c"]


# Partial panels and profiles.


def _raw_events(spark, tmp):
    r = random.Random(3)
    rows = [(r.choice([None, r.randrange(100_000)]), dt.datetime(2024, 1, r.randrange(1, 9), 5), f"2024010{r.randrange(1, 9)}") for _ in range(400)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, ymd string")
    L.load_raw(df, f"{tmp}/raw")
    return spark.read.schema(df.schema).parquet(f"{tmp}/raw")


def test_distinct_users_add_up(spark, tmp):
    raw = _raw_events(spark, tmp)
    day = F.to_date("ts")
    for days in (["20240101", "20240102", "20240103"], ["20240104", "20240105", "20240106", "20240107", "20240108"], ["20240103"]):
        U.refresh_partials(U.activity_partials, raw, f"{tmp}/dau", days, day)
    got = {r.dt: r.dau for r in U.dau(spark.read.parquet(f"{tmp}/dau")).collect()}
    want = {r.d: r.n for r in raw.groupBy(day.alias("d")).agg(F.countDistinct("user_id").alias("n")).collect()}
    assert got == want
    # A day that is empty now loses its part.
    U.refresh_partials(U.activity_partials, raw.where("ymd <> '20240103'"), f"{tmp}/dau", ["20240103"], day)
    assert "20240103" not in inc.partition_values(spark, f"{tmp}/dau", "ymd")


def test_refreshes_read_the_changed_partitions_only(spark, tmp):
    raw = _raw_events(spark, tmp)
    plan = U.activity_partials(raw.where(F.col("ymd").isin(["20240102"])), F.to_date("ts"))._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "ymd#" in plan.split("PartitionFilters: [")[1][:120] and "user_id" in plan
    profile = P.partition_profile(raw.where(F.col("ymd").isin(["20240102"])), "ymd", F.to_date("ts"), ["user_id"])
    plan = profile._jdf.queryExecution().toString()
    assert "ymd#" in plan.split("PartitionFilters: [")[1][:120]


def test_profiles_answer_the_column_tests(spark, tmp):
    rows = [("a", 1, "20240101"), (" ", None, "20240101"), (None, 2, "20240102"), ("", 3, None)]
    df = spark.createDataFrame(rows, "s string, n int, ymd string").withColumn("d", F.to_date("ymd", "yyyyMMdd"))
    P.refresh_profile(df, f"{tmp}/p", "ymd", ["20240101", None], F.col("d"), ["s", "n"], ["s"])
    P.refresh_profile(df, f"{tmp}/p", "ymd", ["20240102"], F.col("d"), ["s", "n"], ["s"])
    P.refresh_profile(df, f"{tmp}/p", "ymd", ["20240101"], F.col("d"), ["s", "n"], ["s"])
    got = P.audit_from_profile(spark.read.parquet(f"{tmp}/p"), "t", ["s", "n"], ["s"])
    want = C.column_audit(df, "t", not_null=["s", "n"], not_empty=["s"])
    key = lambda x: sorted((r.table_name, r.test_name, r.column_name, r.failures) for r in x.collect())
    assert key(got) == key(want)
    for day in ("2024-01-02", "2024-01-05"):
        one = P.todays_data_from_profile(spark.read.parquet(f"{tmp}/p"), day, "t").collect()
        assert one == C.has_todays_data(df.withColumn("e", F.col("d")), day, "e", "t").collect()
    # No partition, no row: every count is 0.
    P.refresh_profile(df.where("false"), f"{tmp}/p", "ymd", ["20240101", "20240102", None], F.col("d"), ["s", "n"], ["s"])
    assert {r.failures for r in P.audit_from_profile(spark.read.schema("part string, null_s long, null_n long, blank_s long").parquet(f"{tmp}/p"), "t", ["s", "n"], ["s"]).collect()} == {0}


# The job log.


def test_a_run_is_one_file_and_a_failing_one_is_logged(spark, tmp):
    with J.JobLogger(spark, f"{tmp}/log", "fact", "daily", "f.py") as log:
        log.log("start")
        log.log("success")
        log.log("end")
    with pytest.raises(KeyError):
        with J.JobLogger(spark, f"{tmp}/log", "panel", "daily", "f.py") as log:
            log.log("start")
            raise KeyError("x")
    rows = J.read_log(spark, f"{tmp}/log")
    assert sorted((r.job_name, r.step_id, r.step_name) for r in rows.collect()) == [
        ("fact", 1, "start"), ("fact", 2, "success"), ("fact", 3, "end"), ("panel", 1, "start"), ("panel", 2, "error")]
    assert FL.file_table(spark, f"{tmp}/log").count() == 2


def test_compaction_keeps_rows_and_survives_a_stop(spark, tmp, monkeypatch):
    path = f"{tmp}/log"
    assert J.read_log(spark, path).count() == 0
    for i in range(6):
        J.JobLogger(spark, path, f"j{i}", "daily" if i % 2 else "hourly", "f.py").log("end")
    assert J.compact_log(spark, path) == 2 and J.read_log(spark, path).count() == 6
    # Stopped between the two renames: the old table is taken back.
    jvm = spark.sparkContext._jvm
    fs, p = inc._fs(spark, path)
    assert fs.rename(p, jvm.org.apache.hadoop.fs.Path(path + "__old"))
    assert J.read_log(spark, path).count() == 6
    # Appended to meanwhile: done again, no row lost.
    real, calls = J.file_table, []

    def meddled(s, where, *more):
        calls.append(where)
        if len(calls) == 2:
            J.JobLogger(spark, path, "late", "daily", "f.py").log("end")
        return real(s, where, *more)

    monkeypatch.setattr(J, "file_table", meddled)
    J.compact_log(spark, path)
    assert J.read_log(spark, path).count() == 7


def test_compacted_files_follow_the_bytes(spark, tmp, monkeypatch):
    kind = "CASE id % 8 WHEN 0 THEN NULL WHEN 1 THEN 'hourly' ELSE 'daily' END"
    given = {"ts": "timestamp_ntz'2024-01-01 07:00:00'", "uid": "hex(id)", "job_type": kind, "step_id": "id"}
    log = spark.range(40_000).selectExpr(*[f"CAST({given.get(f.name, 'CAST(id AS STRING)')} AS {f.dataType.simpleString()}) AS {f.name}" for f in JOB_LOG.fields])
    log.repartition(16).write.partitionBy("job_type").parquet(f"{tmp}/log")
    # Spark may cut its shuffles finely: that is no reason for more files.
    monkeypatch.setattr(J, "COMPACT_BYTES", 1 << 19)
    sizes = {r[0]: r[1] for r in FL.file_table(spark, f"{tmp}/log").groupBy(F.regexp_extract("path", "job_type=([^/]*)", 1)).agg(F.sum("n_bytes")).collect()}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        files = J.compact_log(spark, f"{tmp}/log")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(sizes) == 3 and 3 <= files <= sum(-(-n // (1 << 19)) for n in sizes.values())
    back = J.read_log(spark, f"{tmp}/log")
    assert back.count() == 40_000 and back.exceptAll(log).count() == 0


def test_the_round_of_a_large_log(spark, tmp):
    orders = spark.range(60_000).selectExpr(
        "id AS o_orderkey", "id % 1000 AS o_custkey", "element_at(array('F', 'O', 'P'), CAST(id % 3 + 1 AS INT)) AS o_orderstatus", "1.0D AS o_totalprice",
        "timestamp_ntz'1998-07-01 00:00:00' + make_dt_interval(CAST(id % 30 AS INT)) AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    orders.write.parquet(f"{tmp}/orders.parquet")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        assert {r.log_rows for r in catalog.QUERIES["job_log_round"](spark, tmp).collect()} == {60_007}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_flags_round_trip(spark, tmp):
    row_ = (dt.datetime(2024, 1, 1, 7, 0, 0, 250000), "2024-01-01", "u", "me", "j", "daily", "f.py", "end", 3, "prod", "f.py --days-back 2")
    stale = spark.createDataFrame([row_], JOB_LOG).selectExpr("'a' AS alert_name", "true AS raise_flag", "'2024-01-01' AS lt", "*")
    J.write_flags(stale, f"{tmp}/flags")
    back = J.read_flags(spark, f"{tmp}/flags")
    assert back.dtypes == stale.dtypes and back.collect() == stale.collect()
    J.write_flags(stale.where("false"), f"{tmp}/none")
    assert J.read_flags(spark, f"{tmp}/none").count() == 0


# Contracts, shapes, names.


def test_contracts(spark, tmp):
    schema = "a int, dt date"
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1))], schema)
    with pytest.raises(ValueError, match="init"):
        inc.read_declared(spark, f"{tmp}/t")
    inc.init_table(spark, f"{tmp}/t", df.schema, "dt")
    assert inc.read_declared(spark, f"{tmp}/t").count() == 0 and inc.read_declared(spark, f"{tmp}/t").dtypes == df.dtypes
    inc.commit_window(df, f"{tmp}/t", "dt", "2024-01-01")
    assert inc.read_declared(spark, f"{tmp}/t").collect() == df.collect()
    for odd, key, what in ((df.withColumn("a", F.lit("x")), "dt", "a is string, declared int"), (df.withColumn("b", F.lit(1)), "dt", "b is int, declared absent"),
                           (df, "a", "partitioned by a, declared dt")):
        with pytest.raises(ValueError, match=what):
            inc.commit_window(odd, f"{tmp}/t", key, "2024-01-01")
    inc.init_table(spark, f"{tmp}/t", df.schema, "dt")
    assert inc.read_declared(spark, f"{tmp}/t").count() == 0


def test_types_widen():
    assert [SH.wider(a, b) for a, b in (("int", "double"), ("int", "bigint"), ("bigint", "float"), ("smallint", "float"), ("date", "timestamp_ntz"),
                                        ("int", "string"), ("void", "date"), ("boolean", "boolean"), ("date", "int"),
                                        ("decimal(10,2)", "decimal(5,4)"), ("int", "decimal(10,2)"), ("double", "decimal(10,2)"), ("decimal(38,0)", "decimal(38,20)"))] == [
        "double", "bigint", "double", "float", "timestamp_ntz", "string", "date", "boolean", "string", "decimal(12,4)", "decimal(12,2)", "double", "double"]
    for a in ("int", "date", "string", "decimal(3,1)", "double", "boolean"):
        for b in ("bigint", "timestamp", "decimal(20,3)", "float"):
            assert SH.wider(a, b) == SH.wider(b, a)


def test_files_of_several_shapes(spark, tmp):
    put(f"{tmp}/20240101/a.csv", "id,cost\n1,2\n")
    put(f"{tmp}/20240101/b.csv", "cost,id,extra\n2.5,2,\"x, \"\"y\"\"\"\n")
    put(f"{tmp}/20240102/c.csv", "id\n3\n")
    put(f"{tmp}/20240102/d.csv", "cost,id\nn/a,4\n")
    got = SH.read_shapes(spark, tmp)
    assert dict(got.dtypes) == {"id": "int", "cost": "string", "extra": "string", "ymd": "string"}
    assert sorted((r.id, r.cost, r.extra, r.ymd) for r in got.collect()) == [
        (1, "2", None, "20240101"), (2, "2.5", 'x, "y"', "20240101"), (3, None, None, "20240102"), (4, "n/a", None, "20240102")]
    os.remove(f"{tmp}/20240102/d.csv")
    assert dict(SH.read_shapes(spark, tmp).dtypes)["cost"] == "double"
    fixed = SH.read_shapes(spark, f"{tmp}/20240101", declared=spark.createDataFrame([], "cost double, id long").schema)
    assert fixed.dtypes == [("cost", "double"), ("id", "bigint"), ("ymd", "string")]
    assert sorted(tuple(r) for r in fixed.collect()) == [(2.0, 1, "20240101"), (2.5, 2, "20240101")]


def test_tables_named_after_files(spark, tmp):
    root, where, cat = f"{tmp}/in", f"{tmp}/tables", f"{tmp}/catalog"
    for d in (1, 9):
        put(f"{root}/2024010{d}/in-app v2.csv", HEAD + row(d))
        put(f"{root}/2024010{d}/notes.csv", "a\n1\n2\n")
    for day in ("20240101", "20240109", "20240109"):
        assert set(TB.load_by_file_name(spark, root, day, where, cat, {"in_app_v2": INAPP})) == {f"in_app_v2_{day}", f"notes_{day}"}
    assert TB.read_catalog(spark, cat).count() == 4
    assert TB.read_named(spark, cat, "notes").count() == 4 and TB.read_named(spark, cat, "notes", dt.date(2024, 1, 5)).count() == 2
    assert TB.expire_by_name(spark, cat, dt.date(2024, 1, 9), days=7) == ["in_app_v2_20240101", "notes_20240101"]
    assert TB.expire_by_name(spark, cat, dt.date(2024, 1, 9), days=7) == []
    assert sorted((r.name, r.state) for r in TB.read_catalog(spark, cat).collect())[::2] == [("in_app_v2_20240101", "expired"), ("notes_20240101", "expired")]
    assert not os.path.exists(f"{where}/notes_20240101") and TB.read_named(spark, cat, "in_app_v2").count() == 1
    put(f"{root}/20240109/in_app v2.csv", HEAD)
    with pytest.raises(ValueError, match="several files"):
        TB.load_by_file_name(spark, root, "20240109", where, cat)
