import datetime as dt

from pyspark.sql import functions as F

from roasty.schemas import FACT_TAGGED, INAPP, INSTALLS

D = dt.date
TS = dt.datetime


def install_row(**kw):
    base = dict(
        install_time=TS(2024, 1, 10, 8), event_time=TS(2024, 1, 10, 8), event_name="install",
        event_revenue=0.0, event_value="{}", event_revenue_usd=0.0, af_cost_model="CPI", af_cost_value=1.0,
        af_cost_currency="USD", event_source="SDK", media_source="facebook_int", af_channel="Facebook",
        af_keywords=None, install_app_store="itunes", campaign="c1", country_code="US", platform="ios",
        app_version="1.5.1", app_name="app", appsflyer_id="id-1",
    )
    base.update(kw)
    return tuple(base[f.name] for f in INSTALLS.fields)


def inapp_row(**kw):
    base = dict(
        install_time=TS(2024, 1, 1, 8), event_time=TS(2024, 1, 10, 9), event_name="af_purchase",
        event_value='{"a": 1, "b": "0"}', event_revenue=6.99, event_revenue_usd=6.99, af_cost_currency=None,
        af_cost_value=None, media_source="facebook_int", campaign="c1", af_channel="Facebook", country_code="US",
        event_source="SDK", af_keywords=None, install_app_store="itunes", platform="ios", app_version="1.5.1",
        app_name="a",
    )
    base.update(kw)
    return tuple(base[f.name] for f in INAPP.fields)


def installs_df(spark, rows, ymd=None):
    df = spark.createDataFrame(rows, INSTALLS)
    return df.withColumn("ymd", F.lit(ymd) if ymd else F.date_format("event_time", "yyyyMMdd"))


def inapp_df(spark, rows, ymd=None):
    df = spark.createDataFrame(rows, INAPP)
    return df.withColumn("ymd", F.lit(ymd) if ymd else F.date_format("event_time", "yyyyMMdd"))


def fact_row(**kw):
    base = dict(zip(INSTALLS.fieldNames(), install_row()))
    base.update(dt=kw.get("event_time", base["event_time"]).date(), data_source="installs")
    base.update(kw)
    if "event_time" in kw and "dt" not in kw:
        base["dt"] = kw["event_time"].date()
    return tuple(base[f.name] for f in FACT_TAGGED.fields)


def fact_df(spark, rows):
    return spark.createDataFrame(rows, FACT_TAGGED)


def as_dicts(df, key=None):
    rows = [r.asDict() for r in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[k]) for k in (key or sorted(r))))
