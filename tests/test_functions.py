import datetime as dt

from pyspark.sql import functions as F

from roasty.functions import (
    date_in_name,
    hour_boundaries_between,
    is_blank,
    money_sum,
    safe_name,
    strip_days_back,
    whole_hours_between,
)


def test_hour_differences_boundaries_vs_whole(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 59),)], "ts timestamp_ntz")
    end = dt.datetime(2024, 1, 1, 2, 0)
    r = df.select(hour_boundaries_between("ts", end).alias("b"), whole_hours_between("ts", end).alias("w")).first()
    assert (r.b, r.w) == (2, 1)


def test_strip_days_back_and_safe_name(spark):
    df = spark.createDataFrame([("x.py p --days-back 3", "vendor-installs data.csv")], "m string, n string")
    r = df.select(strip_days_back("m").alias("m"), safe_name("n").alias("n")).first()
    assert r.m == "x.py p"
    assert r.n == "vendor_installs_data_csv"


def test_date_in_name(spark):
    df = spark.createDataFrame([("a_20240105.csv",), ("undated.csv",), ("bad_20241399.csv",)], "n string")
    got = [r.d for r in df.select(date_in_name("n").alias("d")).collect()]
    assert got == [dt.date(2024, 1, 5), None, None]


def test_blank_is_not_null(spark):
    df = spark.createDataFrame([("  ",), (None,), ("x",)], "s string")
    got = [r.b for r in df.select(is_blank("s").alias("b")).collect()]
    assert got == [True, None, False]


def test_money_sum_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 1.25), ("b", -1.25), ("b", -1.25), ("c", 0.1), ("c", 0.2)], "k string, v double")
    got = {r.k: r.s for r in df.groupBy("k").agg(F.round(money_sum("v")).alias("s")).collect()}
    assert got == {"a": 3.0, "b": -3.0, "c": 0.0}
    exact = {r.k: r.s for r in df.groupBy("k").agg(money_sum("v").alias("s")).collect()}
    assert exact["c"] == 0.3  # a double sum would give 0.30000000000000004


def test_money_sum_all_null_is_null(spark):
    df = spark.createDataFrame([("a", None)], "k string, v double")
    assert df.agg(money_sum("v").alias("s")).first().s is None


def test_conditional_counts_macro(spark):
    from roasty.functions import conditional_counts

    df = spark.createDataFrame([("a", "ios"), ("a", "ios"), ("b", "android")], "k string, platform string")
    r = {x.k: x for x in df.groupBy("k").agg(*conditional_counts("platform", ["ios", "android"])).collect()}
    assert (r["a"].t_ios, r["a"].t_android, r["b"].t_ios, r["b"].t_android) == (2, None, None, 1)


def test_cluster_conf_sizes_from_slots():
    from roasty.session import cluster_conf

    conf = cluster_conf(input_bytes=100 * 10**12, executors=1000, cores_per_executor=8)
    assert conf["spark.sql.shuffle.partitions"] == str(4 * 8000)  # capped by the slots, not 400k scan tasks
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    assert conf["spark.sql.adaptive.enabled"] == "true" and conf["spark.sql.session.timeZone"] == "UTC"
    small = cluster_conf(input_bytes=10**9, executors=2, cores_per_executor=4)
    assert small["spark.sql.shuffle.partitions"] == "16"


def test_apply_defaults_on_a_running_session(spark):
    from roasty.session import apply_defaults

    apply_defaults(spark)  # static settings (UI, retention) are skipped, not an error
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "dynamic"
