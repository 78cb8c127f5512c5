"""Numeric helpers: half-up rounding, exact sums and averages, guarded
ratios, rounding casts.

All helpers return Catalyst expressions (no UDFs), so they stay inside
whole-stage code generation. A double stands for its shortest decimal form
(1.005, stored as 1.00499999..., is 1.005): it is rounded once, half away from
zero, from that form. Sums add these forms exactly, so they do not depend on row
order or partitioning: each value falls in one bin by its size and digits, every bin
holds whole multiples of its own unit and is summed as such, and the bins' sums are
put together once. NaN, infinities and doubles from 1e18 on have a bin of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.util import as_col

# Amounts of up to six decimals and 15 digits, which is nearly all of them, are whole
# numbers of millionths; their sum is kept in two parts that no count of rows overflows.
_UNIT = 1e6
_DIGITS = 1e15
_SPLIT = 20
# The others are decimals with room for a million of the largest; digits past the
# 14th decimal are cut. Doubles from _HUGE on carry no cents and are added as such.
_OTHER = "decimal(38,14)"
_HUGE = 1e18
PARTS = ["hi", "lo", "other", "rest"]


def round2(c, places: int = 2) -> Column:
    """ROUND(x, places), half away from zero on the shortest decimal form of
    ``x``; NULL, NaN and infinities stay."""
    return F.round(as_col(c), places)


def sum_parts(c) -> dict[str, Column]:
    """SUM as parts, by the names of PARTS; parts of several groups merge by SUM."""
    col = as_col(c).cast("double")
    units = F.rint(col * _UNIT)
    # such a number of units is the shortest decimal form, and no other is as short
    whole = (F.abs(units) < _DIGITS) & (units / _UNIT == col)
    n = F.when(whole, units.cast("bigint"))
    huge = F.abs(col) >= _HUGE           # NaN too, which sorts above all numbers
    parts = {"hi": F.shiftright(n, _SPLIT), "lo": n.bitwiseAND((1 << _SPLIT) - 1),
             "other": F.when(~whole & ~huge, col.cast(_OTHER)), "rest": F.when(huge, col)}
    return {name: F.sum(part) for name, part in parts.items()}


def from_parts(parts: dict[str, Column]) -> Column:
    """The sum as a double; NULL when there was no value."""
    p = {name: as_col(part) for name, part in parts.items()}
    # below 2^53 units are exact as a double, and so is their quotient's rounding
    few = F.abs(p["hi"]) < 1 << (53 - _SPLIT)
    units = (p["hi"].cast("decimal(20,0)") * (1 << _SPLIT) + p["lo"]).cast("decimal(32,0)")
    amount = (units * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(37,14)")
    exact = (F.when(p["other"].isNull() & (few | p["hi"].isNull()),
                    (F.shiftleft(p["hi"], _SPLIT) + p["lo"]) / F.lit(_UNIT))
             .otherwise((F.coalesce(amount, F.lit(0).cast("decimal(37,14)"))
                         + F.coalesce(p["other"].cast("decimal(37,14)"),
                                      F.lit(0).cast("decimal(37,14)"))).cast("double")))
    return F.when(p["rest"].isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + p["rest"])


def exact_sum(c) -> Column:
    """SUM, exact in decimals, as the nearest double."""
    return from_parts(sum_parts(c))


def exact_avg(c) -> Column:
    """AVG: exact sum / non-null count; NULL when there is no non-null value."""
    col = as_col(c)
    n = F.count(col)
    return F.when(n > 0, exact_sum(col) / n.cast("double"))


def guarded_ratio(num, den, scale: float = 1.0) -> Column:
    """(num / den) * scale when den > 0, else NULL (no division by zero)."""
    d = as_col(den)
    return F.when(d > 0, (as_col(num) / d) * F.lit(scale))


def to_int(c) -> Column:
    """Cast to INTEGER rounding fractional values half-up (a plain Spark cast
    truncates: 1.5 -> 1; a warehouse cast rounds: 1.5 -> 2)."""
    return F.round(as_col(c)).cast("int")
