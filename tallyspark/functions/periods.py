"""Period arithmetic on YYYYMM integers and fiscal calendars with any start month."""

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def period_key_of(year, month) -> Column:
    return (_c(year) * 100 + _c(month)).cast("int")


def period_of_date(d) -> Column:
    return period_key_of(F.year(_c(d)), F.month(_c(d)))


def fiscal_year_of(d, start_month=1) -> Column:
    d = _c(d)
    return (F.year(d) - F.when(F.month(d) < start_month, 1).otherwise(0)).cast("int")


def fiscal_period_of(d, start_month=1) -> Column:
    return ((F.month(_c(d)) - start_month + 12) % 12 + 1).cast("int")


def fiscal_quarter_of(d, start_month=1) -> Column:
    return F.ceil(fiscal_period_of(d, start_month) / 3).cast("int")


def month_index(period) -> Column:
    """Months since year 0: consecutive integers, so windows and joins can use plain differences."""
    p = _c(period)
    return (F.floor(p / 100) * 12 + p % 100 - 1).cast("int")


def period_of_index(idx) -> Column:
    i = _c(idx)
    return (F.floor(i / 12) * 100 + i % 12 + 1).cast("int")


def period_add(period, months) -> Column:
    return period_of_index(month_index(period) + months)


def prior_period_key(period) -> Column:
    return period_add(period, -1)


def prior_year_key(period) -> Column:
    return (_c(period) - 100).cast("int")


def period_start_date(period) -> Column:
    p = _c(period)
    return F.make_date(F.floor(p / 100).cast("int"), (p % 100).cast("int"), F.lit(1))


def period_end_date(period) -> Column:
    return F.last_day(period_start_date(period))


def in_fiscal_year(period, fiscal_year, start_month=1) -> Column:
    first = month_index(F.lit(fiscal_year * 100 + start_month))
    return month_index(period).between(first, first + 11)


MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
               "November", "December"]


def period_label(period) -> Column:
    p = _c(period)
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return F.concat(F.element_at(names, (p % 100).cast("int")), F.lit(" "), F.floor(p / 100).cast("string"))


def is_valid_period(period) -> Column:
    p = _c(period)
    return F.coalesce(p.between(200001, 209912) & (p % 100).between(1, 12), F.lit(False))
