"""Loads and refreshes that must not lose or double a row."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from roasty.functions.aggregates import money_round, money_sum, money_total
from roasty.operators import checks as C
from roasty.operators import fact as fact_ops
from roasty.operators import incremental as inc
from roasty.operators.panel import campaign_kpis, campaign_panel
from roasty.plans import daily as chain
from roasty.schemas import FACT_TAGGED, FEEDS, INAPP, INSTALLS, conform
from roasty.sources import landing as L

from helpers import fact_df, fact_row

TYPES = {"install_time": "timestamp_ntz", "event_time": "timestamp_ntz"}


def feed(spark, schema, rows):
    """Feed rows from dicts; columns not given are null, ``ymd`` is the landing day."""
    names = schema.fieldNames()
    data = [tuple(r.get(n) for n in names) + (r["ymd"],) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema) + ", ymd string")


def at(day, hour=12, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def layout(tmp):
    return chain.Layout(f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/fact", f"{tmp}/panel", landing_template="{root}/{feed}/ymd={day}/*.csv")


def land(spark, tmp, installs=(), inapp=()):
    L.write_landing(feed(spark, INSTALLS, list(installs)), f"{tmp}/landing/installs")
    L.write_landing(feed(spark, INAPP, list(inapp)), f"{tmp}/landing/inapp")


def facts(spark, lay):
    return sorted((str(r.dt), r.event_name, r.data_source) for r in chain.read_fact(spark, lay).collect())


def test_sums_keep_small_amounts(spark):
    df = spark.range(30_000).select(F.lit(0.00004).alias("v"))
    got = df.agg(money_sum("v").alias("s"), money_round(money_total("v"), 1).alias("r")).first()
    assert (got.s, got.r) == (1.2, 1.2)
    f = fact_df(spark, [fact_row(event_revenue=0.00004, event_revenue_usd=0.00004, af_cost_value=0.00001) for _ in range(4)])
    assert campaign_panel(f, by_install=False).first().roas == 4.0


def test_cost_per_install_is_of_the_media_source_and_unrounded(spark):
    rows = [fact_row(event_name="install", media_source="a_int", af_channel="Google", af_cost_value=1.4),
            fact_row(event_name="install", media_source="z_int", af_channel="TikTok", af_cost_value=2.25),
            fact_row(event_name="SessionStart", media_source="z_int", af_channel="TikTok", af_cost_value=None)]
    got = {r.media_source: r for r in campaign_kpis(fact_df(spark, rows)).collect()}
    assert (got["a_int"].cpi, got["z_int"].cpi, got["z_int"].events) == (1.4, 2.25, 2)


def test_rows_without_a_day_and_late_rows_stay(spark, tmp):
    lay = layout(tmp)
    days = [{"event_time": at(d), "event_name": f"e{d}", "ymd": f"202401{d:02d}"} for d in range(1, 17)]
    land(spark, tmp, inapp=[*days, {"event_time": None, "event_name": "no time", "ymd": "20240103"},
                            # ten minutes into the day after it landed
                            {"event_time": at(16, 0, 10), "event_name": "early", "ymd": "20240115"}])
    chain.backfill(spark, lay, dt.date(2024, 1, 1), dt.date(2024, 1, 15))
    inc.expire_partitions(spark, lay.raw_path("inapp"), "ymd", dt.date(2024, 1, 16), days=7)
    # The day's files bring a row that is fourteen days late, one that raw
    # still reaches back to, and another without a time.
    land(spark, tmp, inapp=[days[15], {"event_time": at(2), "event_name": "late", "ymd": "20240116"},
                            {"event_time": at(11), "event_name": "late 11", "ymd": "20240116"},
                            {"event_time": None, "event_name": "no time 2", "ymd": "20240116"}])
    want = sorted([(f"2024-01-{d:02d}", f"e{d}", "inapp") for d in range(1, 17)]
                  + [("None", "no time", "inapp"), ("None", "no time 2", "inapp"), ("2024-01-16", "early", "inapp"),
                     ("2024-01-02", "late", "inapp"), ("2024-01-11", "late 11", "inapp")])
    for _ in range(2):  # the rerun changes nothing
        assert chain.backfill(spark, lay, dt.date(2024, 1, 16), dt.date(2024, 1, 16)) == dt.date(2024, 1, 2)
        assert facts(spark, lay) == want
        panel = chain.read_panel(spark, lay)
        assert panel.agg(F.sum("t_events")).first()[0] == len(want)
        assert panel.where("dt IS NULL").first().t_events == 2


def test_refresh_expression_equals_the_one_on_disk(spark):
    inapp = feed(spark, INAPP, [{"event_time": at(9), "event_name": "old", "ymd": "20240110"}, {"event_time": at(10), "event_name": "a", "ymd": "20240110"},
                                {"event_time": at(12, 0, 5), "event_name": "early", "ymd": "20240111"}, {"event_time": at(3), "event_name": "late", "ymd": "20240112"},
                                {"event_time": None, "event_name": "none", "ymd": "20240112"}])
    installs = feed(spark, INSTALLS, [])
    before = fact_ops.build_fact(installs, inapp.where("ymd < '20240112'"))
    gone = conform(spark.createDataFrame([tuple([dt.date(2024, 1, 3)] + [None] * 20 + ["inapp"])], FACT_TAGGED), FACT_TAGGED)
    target = before.unionByName(gone)
    once = fact_ops.refresh_fact(target, installs, inapp, dt.date(2024, 1, 12))
    twice = fact_ops.refresh_fact(once, installs, inapp, dt.date(2024, 1, 12))
    want = sorted(["None", "old", "a", "early", "late", "none"])
    assert sorted(str(r.event_name) for r in once.collect()) == want
    assert sorted(str(r.event_name) for r in twice.collect()) == want


def test_events_far_after_their_landing_day_fail_the_load(spark, tmp):
    land(spark, tmp, inapp=[{"event_time": at(20), "event_name": "x", "ymd": "20240101"}])
    with pytest.raises(Exception, match="event dated after its landing day"):
        chain.load_landing(spark, layout(tmp), ["20240101"])


def test_empty_delivery_empties_the_day(spark, tmp):
    lay = layout(tmp)
    land(spark, tmp, installs=[{"event_time": at(d), "event_name": "install", "ymd": f"2024010{d}"} for d in (1, 2)])
    chain.load_landing(spark, lay, ["20240101", "20240102"])
    land(spark, tmp, installs=[{"event_time": at(1), "event_name": "install", "ymd": "20240101"}])
    inc.drop_table(spark, f"{tmp}/landing/installs/ymd=20240102")
    chain.load_landing(spark, lay, ["20240102"])
    assert [r.ymd for r in L.read_raw(spark, lay.raw_path("installs"), INSTALLS).collect()] == ["20240101"]


def test_csv_columns_go_by_name(spark, tmp):
    (day := f"{tmp}/20240101")
    import os

    os.makedirs(day)
    with open(f"{day}/installs.csv", "w") as f:
        f.write("country_code,extra,campaign,event_time\nUS,x,CAMP,2024-01-01 10:00:00\n")
    got = L.read_landing(spark, f"{day}/installs.csv", schema=INSTALLS).first()
    assert (got.campaign, got.country_code, got.event_time, got.platform, got.ymd) == ("CAMP", "US", at(1, 10), None, "20240101")
    with open(f"{day}/installs2.csv", "w") as f:
        f.write("campaign,extra,country_code,event_time\nCAMP,x,US,2024-01-01 10:00:00\n")
    with pytest.raises(Exception, match="(?i)header"):  # of one load, another order: not read by position
        L.read_landing(spark, [f"{day}/installs.csv", f"{day}/installs2.csv"], schema=INSTALLS).collect()


def test_formats_mix_and_names_that_meet_are_refused(spark, tmp):
    rows = feed(spark, INSTALLS, [{"event_time": at(1), "event_name": "install", "ymd": "20240101"}]).drop("ymd")
    import os
    import shutil

    os.makedirs(f"{tmp}/l/20240101")
    for fmt in ("json", "orc", "parquet"):
        rows.coalesce(1).write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").format(fmt).save(f"{tmp}/w/{fmt}")
        shutil.copy(glob.glob(f"{tmp}/w/{fmt}/part-*")[0], f"{tmp}/l/20240101/installs.{fmt}")
    assert L.load_day_by_file(spark, f"{tmp}/l", "20240101", f"{tmp}/raw", {"installs": INSTALLS}) == {"installs": f"{tmp}/raw/installs"}
    assert L.read_raw(spark, f"{tmp}/raw/installs", INSTALLS).count() == 3
    for name in ("a-b.csv", "a_b.csv"):
        with open(f"{tmp}/l/20240101/{name}", "w") as f:
            f.write("x\n1\n")
    with pytest.raises(ValueError, match="a-b, a_b"):
        L.load_day_by_file(spark, f"{tmp}/l", "20240101", f"{tmp}/raw2", {"installs": INSTALLS})


def test_text_amounts_are_parsed(spark):
    rows = [{"event_time": at(1), "ymd": "20240101", "af_cost_value": v} for v in ("3.5", " ", None)]
    got = fact_ops.build_fact(feed(spark, INSTALLS, []), feed(spark, INAPP, rows)).select("af_cost_value").collect()
    assert sorted(str(r[0]) for r in got) == ["3.5", "None", "None"]
    bad = feed(spark, INAPP, [{"event_time": at(1), "ymd": "20240101", "af_cost_value": "3,5"}])
    with pytest.raises(Exception, match="af_cost_value does not hold a double"):
        fact_ops.build_fact(feed(spark, INSTALLS, []), bad).collect()


def test_an_empty_table_is_not_fresh(spark):
    none = spark.createDataFrame([], "event_time timestamp_ntz")
    now = dt.datetime(2024, 1, 2)
    assert C.freshness(none, "event_time", now, 24, "freshness", "t").first().raise_flag is True
    assert C.freshness_severity(none, now, 6, 24, "event_time", "t").first().severity == "error"


def test_a_day_is_written_by_few_files(spark, tmp):
    rows = [{"event_time": at(d, h), "event_name": "x", "ymd": f"202401{d:02d}"} for d in range(1, 11) for h in range(24)]
    L.load_raw(feed(spark, INAPP, rows).repartition(8), f"{tmp}/raw")
    assert len(glob.glob(f"{tmp}/raw/*/part-*.parquet")) <= 20
    assert set(FEEDS) == {"installs", "inapp"}
