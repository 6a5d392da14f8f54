"""Amount and ratio columns. Amounts are exact; ratios are doubles, nudged before rounding so that ties round away from zero."""

from pyspark.sql import Column, functions as F

TIE_NUDGE = 1 + 1e-12


def amount(c) -> Column:
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


MILLION = 1_000_000


def cents(c) -> Column:
    """An amount as a whole number of hundredths."""
    return (amount(c) * 100).cast("bigint")


def from_cents(c, kind: str = "decimal(18,2)") -> Column:
    return ((F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)


def millionths(rate) -> Column:
    """A rate of six decimals as a whole number; rates up to about four million keep every step within 64 bits."""
    return ((F.col(rate) if isinstance(rate, str) else rate).cast("decimal(16,6)") * MILLION).cast("bigint")


def _whole(x: Column, y: Column) -> Column:
    return F.call_function("div", x, y)


def cents_times(c: Column, rate: Column) -> Column:
    """Hundredths times a rate in millionths, halves away from zero; in whole numbers, so exact."""
    x = F.abs(c)
    million = F.lit(MILLION).cast("bigint")
    return F.sign(c).cast("bigint") * (_whole(x, million) * rate + _whole(2 * (x % million) * rate + million, 2 * million))


def cents_over(c: Column, rate: Column) -> Column:
    """Hundredths divided by a rate in millionths, halves away from zero; null for a rate of zero."""
    x, by = F.abs(c), F.when(rate != 0, rate)
    return F.sign(c).cast("bigint") * (_whole(x, by) * MILLION + _whole(2 * (x % by) * MILLION + by, 2 * by))


def dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def rnd(c, places) -> Column:
    return F.round(dbl(c) * F.lit(TIE_NUDGE), places)


def ratio(num, den, places=None, scale=1.0, otherwise=None) -> Column:
    """num / den * scale; null (or `otherwise`) when the denominator is zero or missing."""
    num, den = dbl(num), dbl(den)
    value = num / den * F.lit(float(scale))
    if places is not None:
        value = rnd(value, places)
    out = F.when(den != 0, value)
    return out if otherwise is None else out.otherwise(F.lit(float(otherwise)))


def sum_where(cond, value) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.sum(F.when(cond, value).otherwise(F.lit(0).cast("decimal(18,2)")))
