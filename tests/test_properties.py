"""Property tests: small random inputs, invariants of the operators."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from helpers import fact_df, fact_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roasty.functions.aggregates import money_sum
from roasty.operators import incremental as inc
from roasty.operators.panel import campaign_panel

D = dt.date
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
cents = st.integers(min_value=-10**7, max_value=10**7)
days = st.integers(min_value=1, max_value=9)


@SETTINGS
@given(st.lists(cents, min_size=1, max_size=40))
def test_money_sum_is_exact(spark, values):
    df = spark.createDataFrame([(v / 100.0,) for v in values], "v double")
    got = df.agg(money_sum("v").alias("s"), F.round(money_sum("v")).alias("r")).first()
    exact = sum(Decimal(v) / 100 for v in values)
    assert Decimal(repr(got.s)) == exact
    assert Decimal(repr(got.r)) == exact.quantize(Decimal(1), rounding=ROUND_HALF_UP)  # ties away from zero


def _frame(spark, pairs, tag):
    return spark.createDataFrame([(D(2024, 1, d), tag, i) for i, d in enumerate(pairs)], "dt date, v string, i int")


@SETTINGS
@given(st.lists(days, max_size=12), st.lists(days, max_size=12), days)
def test_replace_window_idempotent_and_exact(spark, old_days, new_days, frm):
    target = _frame(spark, old_days, "old")
    new = _frame(spark, [d for d in new_days if d >= frm], "new")
    once = inc.replace_window(target, new, "dt", D(2024, 1, frm))
    twice = inc.replace_window(once, new, "dt", D(2024, 1, frm))
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    assert all(r[1] == "new" for r in a if r[0] >= D(2024, 1, frm))
    assert sorted(r for r in a if r[1] == "old") == sorted(tuple(r) for r in target.collect() if r.dt < D(2024, 1, frm))


@SETTINGS
@given(st.lists(days, max_size=12), st.lists(days, max_size=12))
def test_overwrite_partitions_keeps_untouched_days(spark, old_days, new_days):
    target = _frame(spark, old_days, "old")
    new = _frame(spark, new_days, "new")
    out = sorted(tuple(r) for r in inc.overwrite_partitions(target, new, "dt").collect())
    touched = {D(2024, 1, d) for d in new_days}
    want = sorted([tuple(r) for r in target.collect() if r.dt not in touched] + [tuple(r) for r in new.collect()])
    assert out == want


events = st.sampled_from(["install", "af_purchase", "SessionStart", "RealCashBalance", None])
channels = st.sampled_from(["Google", "Facebook", "TikTok", "Organic"])
money = st.one_of(st.none(), cents.map(lambda c: c / 100.0))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["c1", "c2"]), days, events, channels, money, money), min_size=1, max_size=30))
def test_two_step_panel_equals_direct_aggregation(spark, rows):
    fr = [
        fact_row(campaign=c, event_time=dt.datetime(2024, 1, d, 12), event_name=e, af_channel=ch,
                 event_revenue=r, event_revenue_usd=r, af_cost_value=k)
        for c, d, e, ch, r, k in rows
    ]
    fact = fact_df(spark, fr)
    panel = {(r.campaign, r.dt): r for r in campaign_panel(fact, by_install=False).collect()}
    direct = fact.groupBy("campaign", "dt").agg(
        F.max("af_channel").alias("m"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("event_name") == "install", 1)).alias("i"),
        F.sum(F.when(F.col("af_channel") == "Organic", 1)).alias("o"),
        F.round(money_sum("af_cost_value")).alias("cost"),
    ).collect()
    assert len(direct) == len(panel)
    for d in direct:
        p = panel[(d.campaign, d.dt)]
        assert (p.media_source, p.t_events, p.t_install, p.t_Organic, p.cost) == (d.m, d.n, d.i, d.o, d.cost)


late_rows = st.lists(st.tuples(days, st.integers(min_value=0, max_value=2), st.integers(0, 23)), min_size=1, max_size=25)


@SETTINGS
@given(late_rows, st.integers(min_value=1, max_value=12), st.booleans())
def test_refresh_fact_widen_keeps_every_event_once(spark, events, refresh_day, stale_copy):
    from helpers import inapp_df, inapp_row, install_row, installs_df

    from roasty.operators.fact import build_fact, refresh_fact

    rows = [(dt.datetime(2024, 1, d, h), f"202401{d + delay:02d}") for d, delay, h in events]
    app = inapp_df(spark, [inapp_row(event_time=t, campaign=f"{i}") for i, (t, _) in enumerate(rows)])
    app = app.withColumn("ymd", F.element_at(F.array(*[F.lit(y) for _, y in rows]), F.col("campaign").cast("int") + 1))
    inst = installs_df(spark, [install_row()]).where(F.lit(False))
    y = f"202401{refresh_day:02d}"
    # State before the refresh: every file before the refresh day, and
    # possibly a stale copy of some later files.
    loaded = app.where(F.col("ymd") < y) if not stale_copy else app.where((F.col("ymd") < y) | (F.col("campaign") == "0"))
    target = build_fact(inst, loaded)
    out = refresh_fact(target, inst, app, D(2024, 1, refresh_day), late="widen")
    assert sorted(r.campaign for r in out.collect()) == sorted(str(i) for i in range(len(rows)))
