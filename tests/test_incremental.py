import datetime as dt

import pytest
from helpers import TS, fact_df, fact_row, inapp_df, inapp_row, install_row, installs_df
from pyspark.sql import functions as F

from roasty.operators import incremental as inc
from roasty.operators.fact import build_fact, refresh_fact, refresh_fact_lookback

D = dt.date


def _t(spark, pairs):
    return spark.createDataFrame(pairs, "dt date, v string")


def test_replace_window_removes_empty_days_overwrite_keeps_them(spark):
    target = _t(spark, [(D(2024, 1, 1), "old"), (D(2024, 1, 2), "old"), (D(2024, 1, 3), "old")])
    new = _t(spark, [(D(2024, 1, 3), "new")])
    rw = sorted((r.dt.day, r.v) for r in inc.replace_window(target, new, "dt", D(2024, 1, 2)).collect())
    assert rw == [(1, "old"), (3, "new")]
    ow = sorted((r.dt.day, r.v) for r in inc.overwrite_partitions(target, new, "dt").collect())
    assert ow == [(1, "old"), (2, "old"), (3, "new")]


def test_replace_window_late_modes(spark):
    target = _t(spark, [(D(2024, 1, 1), "old"), (D(2024, 1, 2), "old")])
    new = _t(spark, [(D(2024, 1, 1), "late"), (D(2024, 1, 2), "new")])
    with pytest.raises(Exception, match="before the refresh window"):
        inc.replace_window(target, new, "dt", D(2024, 1, 2), late="reject").collect()
    drop = sorted((r.dt.day, r.v) for r in inc.replace_window(target, new, "dt", D(2024, 1, 2), late="drop").collect())
    assert drop == [(1, "old"), (2, "new")]
    widen = sorted((r.dt.day, r.v) for r in inc.replace_window(target, new, "dt", D(2024, 1, 2), late="widen").collect())
    assert widen == [(1, "late"), (2, "new")]


def test_refresh_fact_late_row_no_duplicate_on_rerun(spark):
    # An in-app event of Jan 1, 23:30 lands in the file of Jan 2.
    inst = installs_df(spark, [install_row(event_time=TS(2024, 1, 1, 10)), install_row(event_time=TS(2024, 1, 2, 10))])
    app = inapp_df(spark, [inapp_row(event_time=TS(2024, 1, 1, 23, 30))], ymd="20240102")
    target = build_fact(inst, app)  # state after loading both files
    once = refresh_fact(target, inst, app, D(2024, 1, 2))
    twice = refresh_fact(once, inst, app, D(2024, 1, 2))
    assert once.count() == 3 and twice.count() == 3
    assert sorted(r.dt.day for r in twice.collect()) == [1, 1, 2]


def test_refresh_fact_lookback(spark):
    inst = installs_df(spark, [install_row(event_time=TS(2024, 1, d, 10)) for d in (1, 5, 9)])
    app = inapp_df(spark, [inapp_row(event_time=TS(2024, 1, 9, 11))])
    target = build_fact(inst.where(F.col("ymd") <= "20240105"), app.where(F.lit(False)))
    out = refresh_fact_lookback(target, inst, app, D(2024, 1, 10), lookback_days=7)
    assert sorted(r.dt.day for r in out.collect()) == [1, 5, 9, 9]


def test_retain_strict_and_undated(spark):
    df = spark.createDataFrame([("20240102",), ("20240103",), ("undated",)], "ymd string")
    kept = sorted(r.ymd for r in inc.retain(df, "ymd", D(2024, 1, 10), days=7).collect())
    assert kept == ["20240103", "undated"]


def test_commit_window_on_disk_is_idempotent(spark, tmp):
    path = f"{tmp}/t"
    first = _t(spark, [(D(2024, 1, d), "v1") for d in (1, 2, 3)])
    inc.commit_partitions(first, path, "dt")
    new = _t(spark, [(D(2024, 1, 3), "v2")])
    stale = inc.commit_window(new, path, "dt", D(2024, 1, 2))
    assert stale == ["2024-01-02"]
    inc.commit_window(new, path, "dt", D(2024, 1, 2))
    got = sorted((r.dt.day, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, "v1"), (3, "v2")]
    inc.commit_partitions(_t(spark, [(D(2024, 1, 5), "v3")]), path, "dt")
    assert inc.partition_values(spark, path, "dt") == ["2024-01-01", "2024-01-03", "2024-01-05"]


def test_commit_full_replaces_every_partition(spark, tmp):
    path = f"{tmp}/full"
    inc.commit_partitions(_t(spark, [(D(2024, 1, d), "v1") for d in (1, 2)]), path, "dt")
    inc.commit_full(_t(spark, [(D(2024, 1, 3), "v2")]), path, "dt")
    assert [(r.dt.day, r.v) for r in spark.read.parquet(path).collect()] == [(3, "v2")]
    assert inc.partition_values(spark, path, "dt") == ["2024-01-03"]


def test_overwrite_partitions_prunes_replaced_partitions(spark, tmp):
    path = f"{tmp}/pruned"
    inc.commit_partitions(_t(spark, [(D(2024, 1, d), "v1") for d in (1, 2, 3)]), path, "dt")
    out = inc.overwrite_partitions(spark.read.parquet(path), _t(spark, [(D(2024, 1, 2), "v2")]), "dt")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "array_contains" in plan
    assert sorted((r.dt.day, r.v) for r in out.collect()) == [(1, "v1"), (2, "v2"), (3, "v1")]


def test_retain_by_name(spark):
    df = spark.createDataFrame([("a_20240102.csv",), ("a_20240103.csv",), ("notes.txt",)], "name string")
    kept = sorted(r.name for r in inc.retain_by_name(df, "name", D(2024, 1, 10), days=7).collect())
    assert kept == ["a_20240103.csv", "notes.txt"]


def test_expire_partitions_on_disk(spark, tmp):
    path = f"{tmp}/exp"
    df = spark.createDataFrame([("20240102", 1), ("20240103", 2), ("undated", 3)], "ymd string, v int")
    df.write.partitionBy("ymd").parquet(path)
    assert inc.expire_partitions(spark, path, "ymd", D(2024, 1, 10), days=7) == ["20240102"]
    assert inc.partition_values(spark, path, "ymd") == ["20240103", "undated"]


def test_commit_window_with_no_new_rows_empties_the_window(spark, tmp):
    path = f"{tmp}/w"
    inc.commit_partitions(_t(spark, [(D(2024, 1, d), "v1") for d in (1, 2, 3)]), path, "dt")
    stale = inc.commit_window(_t(spark, []), path, "dt", D(2024, 1, 2))
    assert stale == ["2024-01-02", "2024-01-03"]
    assert [r.dt.day for r in spark.read.parquet(path).collect()] == [1]


def test_commit_window_with_escaped_partition_values(spark, tmp):
    path = f"{tmp}/esc"
    df = lambda rows: spark.createDataFrame(rows, "k string, v string")
    inc.commit_partitions(df([("a/b", "old"), ("c d", "old"), ("e", "old")]), path, "k")
    stale = inc.commit_window(df([("a/b", "new")]), path, "k", "a")
    assert stale == ["c d", "e"]
    assert [(r.k, r.v) for r in spark.read.parquet(path).collect()] == [("a/b", "new")]


def test_commit_window_recovers_from_failures(spark, tmp, monkeypatch):
    path = f"{tmp}/rec"
    inc.commit_partitions(_t(spark, [(D(2024, 1, d), "old") for d in (1, 2, 3)]), path, "dt")
    new = _t(spark, [(D(2024, 1, 3), "new")])

    def state():
        return sorted((r.dt.day, r.v) for r in spark.read.parquet(path).collect())

    # A task fails inside the write: nothing is committed, the table is as before.
    bad = new.withColumn("v", F.when(F.col("dt") > D(2024, 1, 1), F.raise_error(F.lit("lost task"))).otherwise("x"))
    with pytest.raises(Exception, match="lost task"):
        inc.commit_window(bad, path, "dt", D(2024, 1, 2))
    assert state() == [(1, "old"), (2, "old"), (3, "old")]

    # The job dies between the write and the removal of stale days: the
    # rerun finishes the work.
    def die(*a, **k):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(inc, "drop_partitions", die)
    with pytest.raises(RuntimeError, match="driver lost"):
        inc.commit_window(new, path, "dt", D(2024, 1, 2))
    assert state() == [(1, "old"), (2, "old"), (3, "new")]
    monkeypatch.undo()
    inc.commit_window(new, path, "dt", D(2024, 1, 2))
    assert state() == [(1, "old"), (3, "new")]
