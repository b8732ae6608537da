"""Column-level helpers. All of them return built-in Spark expressions, so
they stay inside whole-stage codegen; none is a Python UDF."""

from roasty.functions.aggregates import (
    conditional_counts,
    count_rows,
    money_round,
    money_sum,
    money_total,
    ratio,
    roas,
)
from roasty.functions.dates import (
    as_date,
    as_ts,
    event_date,
    hour_boundaries_between,
    timestamp_millis,
    whole_hours_between,
    ymd,
    date_in_name,
    days_back,
)
from roasty.functions.strings import is_blank, safe_name, strip_days_back

__all__ = [
    "conditional_counts",
    "count_rows",
    "money_sum",
    "money_round",
    "money_total",
    "ratio",
    "roas",
    "as_date",
    "as_ts",
    "event_date",
    "hour_boundaries_between",
    "timestamp_millis",
    "whole_hours_between",
    "ymd",
    "date_in_name",
    "days_back",
    "is_blank",
    "safe_name",
    "strip_days_back",
]
