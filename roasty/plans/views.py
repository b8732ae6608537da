"""SQL access: the chain's tables as temp views, so the panels and checks
can also be written as Spark SQL over the same names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from roasty.operators.fact import union_tagged
from roasty.plans.daily import Layout, read_fact, read_panel
from roasty.schemas import FEEDS
from roasty.sources.landing import path_exists, read_raw, register_external


def register_views(spark: SparkSession, layout: Layout, panel_view: str = "daily_campaign_panel") -> list[str]:
    """Temp views ``raw_<feed>``, ``fact`` and the panel over the tables of
    ``layout`` (those that exist). Returns the names registered."""
    names = []
    for feed in layout.feeds:
        read_raw(spark, layout.raw_path(feed), FEEDS[feed]).createOrReplaceTempView(f"raw_{feed}")
        names.append(f"raw_{feed}")
    for name, path, read in (("fact", layout.fact_path, read_fact), (panel_view, layout.panel_path, read_panel)):
        if path_exists(spark, path):
            read(spark, layout).createOrReplaceTempView(name)
            names.append(name)
    return names


def register_tables(spark: SparkSession, layout: Layout, external: dict[str, str] | None = None, feeds_view: str = "raw_all",
                    panel_view: str = "daily_campaign_panel") -> list[str]:
    """``register_views``, a view ``feeds_view`` over both raw feeds (tagged,
    by name), and external tables over landing files that are not loaded
    (``{name: glob}``, with the declared columns of the feed of that name).
    Views that exist are replaced in place: plans by name see the new ones."""
    names = register_views(spark, layout, panel_view)
    raw = {f: spark.table(f"raw_{f}") for f in layout.feeds}
    union_tagged(raw).createOrReplaceTempView(feeds_view)
    for name, glob in (external or {}).items():
        register_external(spark, f"ext_{name}", glob, schema=FEEDS[name])
    return [*names, feeds_view, *(f"ext_{n}" for n in external or {})]


def by_name(spark: SparkSession):
    """A resolver for ``run_validation``: tables by their name in the session
    catalog, the dataset being its prefix if there is such a database."""

    def resolve(dataset: str, table: str):
        if dataset and spark.catalog.tableExists(f"{dataset}.{table}"):
            return spark.table(f"{dataset}.{table}")
        return spark.table(table)

    return resolve
