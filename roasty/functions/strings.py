"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: str | Column) -> Column:
    """``TRIM(c) = ''``. NULL is not blank (a separate not-null test exists)."""
    return F.trim(_col(c)) == F.lit("")


def safe_name(c: str | Column) -> Column:
    """Table-safe name: every character outside ``[A-Za-z0-9_]`` becomes ``_``."""
    return F.regexp_replace(_col(c), r"[^a-zA-Z0-9_]", "_")


def strip_days_back(c: str | Column) -> Column:
    """Remove a ``--days-back N`` argument from a logged command line."""
    return F.trim(F.regexp_replace(_col(c), r"\s*--days-back\s+\d+", ""))
