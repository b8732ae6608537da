"""Aggregate expressions used by the panels and checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as a decimal with 18 places: exact for every amount a feed
# writes (a double goes in by its shortest decimal form), associative, so a
# panel comes out bit-identical however the rows are partitioned. The integer
# part of a sum has room for 20 digits; beyond it the sum fails.
MONEY_TYPE = "decimal(38,18)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def count_rows() -> Column:
    """``COUNT(1)``."""
    return F.count(F.lit(1))


def conditional_counts(
    column: str,
    values: Iterable[str],
    names: Mapping[str, str] | None = None,
    prefix: str = "t_",
) -> list[Column]:
    """One ``SUM(CASE WHEN column = v THEN 1 END)`` per value: a manual pivot.

    The sum is NULL, not 0, for a group where nothing matches. The default
    name of each column is ``prefix + value``.
    """
    out = []
    for v in values:
        name = names[v] if names and v in names else f"{prefix}{v}"
        out.append(F.sum(F.when(F.col(column) == F.lit(v), F.lit(1))).cast("long").alias(name))
    return out


def money_total(c: str | Column) -> Column:
    """Exact sum of a money column of doubles as a decimal; NULL if every
    input is NULL. Round this, not its double, where a result is rounded.

    An amount below a million with six decimals at most is a whole number of
    millionths: those are summed as two longs (the low 20 bits and the rest,
    which no number of rows overflows), without a decimal per row. Such an
    amount has 12 digits at most, so its double stands for that decimal and no
    other. Only what is not of this kind is summed as decimals."""
    amount = _col(c)
    d = amount.cast("double")
    units = F.when(F.abs(d) < 1e6, F.rint(d * 1e6).cast("long"))
    plain = units.cast("double") / 1e6 == d
    high = F.sum(F.when(plain, F.shiftright(units, 20)))
    low = F.sum(F.when(plain, units.bitwiseAND(F.lit((1 << 20) - 1))))
    millionth = F.lit(Decimal("0.000001"))
    quick = ((high.cast("decimal(20,0)") * F.lit(1 << 20) + low.cast("decimal(20,0)")).cast("decimal(31,0)") * millionth).cast(MONEY_TYPE)
    rest = F.sum(F.when(~F.coalesce(plain, F.lit(False)), amount.cast(MONEY_TYPE))).cast(MONEY_TYPE)
    return F.when(rest.isNull(), quick).when(high.isNull(), rest).otherwise((quick + rest).cast(MONEY_TYPE))


def money_merge(c: str | Column) -> Column:
    """Sum of ``money_total`` results."""
    return F.sum(_col(c)).cast(MONEY_TYPE)


def money_round(total: str | Column, scale: int = 0) -> Column:
    """A decimal total rounded half away from zero, as a double."""
    return F.round(_col(total), scale).cast("double")


def money_sum(c: str | Column) -> Column:
    """``money_total`` as the nearest double."""
    return money_total(c).cast("double")


# Operands of an exact ratio: narrow enough that a hundredfold keeps all places.
RATIO_TYPE = "decimal(33,18)"


def ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``ROUND(num / NULLIF(den, 0), scale)``: NULL when ``den`` is 0 or NULL.

    Decimals and whole numbers are divided exactly and rounded once, half away
    from zero: by the remainder of a whole division, as a decimal quotient
    would be cut to few places first and a double one can miss a tie. Operands
    of 10^15 or more, or a quotient as large, are divided as doubles."""
    n, d = num.try_cast(RATIO_TYPE), F.nullif(den, F.lit(0)).try_cast(RATIO_TYPE)
    about = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    units = n * F.lit(10**scale)
    rest = F.abs(units % d)
    up = F.when(rest * 2 >= F.abs(d), F.when((n < 0) == (d < 0), 1).otherwise(-1)).otherwise(0)
    exact = (F.call_function("div", units, d) + up).cast("double") / float(10**scale)
    return F.when(n.isNotNull() & d.isNotNull() & (F.abs(about) < 1e15 / 10**scale), exact).otherwise(F.round(about, scale))


def roas(revenue: str | Column, cost: str | Column, scale: int = 2) -> Column:
    """``ROUND(SUM(revenue) / NULLIF(SUM(cost), 0), 2)``: NULL when the cost
    total is 0 or NULL."""
    return ratio(money_total(revenue), money_total(cost), scale)
