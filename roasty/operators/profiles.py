"""Profiles of a table's partitions, from which checks are answered.

A profile holds, for each partition and event day, the number of rows and for
each tested column how many are null and how many blank. Profiles add up, so
after a load only the partitions that changed are scanned again; the column
tests, the not-empty tests and the today's-data test of the whole table then
read the profile alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.functions.dates import as_date
from roasty.functions.strings import is_blank
from roasty.operators.incremental import commit_keys


def partition_profile(df: DataFrame, key: str, day: Column, not_null: Sequence[str] = (), not_empty: Sequence[str] = ()) -> DataFrame:
    """One row per partition ``key`` and event ``day``: ``n_rows``, a
    ``null_<column>`` and a ``blank_<column>`` each. One scan, one hash
    aggregation of counts."""
    return df.groupBy(F.col(key).alias("part"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
        *[F.count_if(is_blank(c)).alias(f"blank_{c}") for c in not_empty],
    )


def refresh_profile(df: DataFrame, path: str, key: str, parts: Iterable, day: Column, not_null: Sequence[str] = (),
                    not_empty: Sequence[str] = ()) -> None:
    """Profile the given partitions of ``df`` (a partition filter; None stands
    for the rows without a key) and replace them in the profile at ``path``;
    partitions that are empty now lose theirs."""
    parts = set(parts)
    known = [p for p in parts if p is not None]
    here = F.col(key).isin(known) if known else F.lit(False)
    here = here | F.col(key).isNull() if None in parts else here
    commit_keys(partition_profile(df.where(here), key, day, not_null, not_empty), path, "part", parts)


def audit_from_profile(profile: DataFrame, table_name: str, not_null: Sequence[str] = (), not_empty: Sequence[str] = ()) -> DataFrame:
    """``table_name, test_name, column_name, failures`` of the whole table, as
    ``checks.column_audit`` gives them from its rows."""
    tests = [("not_null", c, f"null_{c}") for c in not_null] + [("string_not_empty", c, f"blank_{c}") for c in not_empty]
    sums = profile.agg(*[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for _, _, name in tests])
    each = F.array(*[F.struct(F.lit(test).alias("test_name"), F.lit(c).alias("column_name"), F.col(f"`{name}`").alias("failures")) for test, c, name in tests])
    return sums.select(F.lit(table_name).alias("table_name"), F.inline(each))


def todays_data_from_profile(profile: DataFrame, as_of, table_name: str) -> DataFrame:
    """``checks.has_todays_data`` from the profile: one row if no row of the
    table is of the day."""
    today = as_date(as_of)
    return (
        profile.agg(
            F.coalesce(F.sum(F.when(F.col("day") != today, F.col("n_rows"))), F.lit(0)).alias("failures"),
            F.coalesce(F.sum(F.when(F.col("day") == today, F.col("n_rows"))), F.lit(0)).alias("_today"),
        )
        .where("_today = 0")
        .select(F.lit(table_name).alias("table_name"), today.alias("as_of"), "failures")
    )


def row_counts_from_profiles(profiles: dict[str, DataFrame]) -> DataFrame:
    """``table_name, day, n_rows`` of several tables' profiles."""
    parts = [p.groupBy("day").agg(F.sum("n_rows").alias("n_rows")).select(F.lit(t).alias("table_name"), "day", "n_rows") for t, p in profiles.items()]
    return reduce(DataFrame.unionByName, parts)
