"""Window building blocks. Frames here are monthly aggregates (entity x month), never postings."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import dbl, ratio
from ..functions.periods import month_index

ENTITY = ("entity_key",)


def by_period(keys=ENTITY):
    return Window.partitionBy(*keys).orderBy("period_key")


def trailing_rows(c: str, n: int = 12, keys=ENTITY) -> Column:
    """Sum of the last n rows, whatever months they are."""
    return F.sum(c).over(by_period(keys).rowsBetween(1 - n, 0))


def trailing_months(c: str, n: int = 12, keys=ENTITY) -> Column:
    """Sum of the last n calendar months; missing months count as empty."""
    return F.sum(c).over(Window.partitionBy(*keys).orderBy(month_index("period_key")).rangeBetween(1 - n, 0))


def previous(c: str, keys=ENTITY) -> Column:
    return F.lag(c).over(by_period(keys))


def moving_average(c: str, n: int = 2, keys=ENTITY) -> Column:
    """Mean of the last n rows from exact sums, so both ends of a tie round the same way."""
    w = by_period(keys).rowsBetween(1 - n, 0)
    return dbl(F.sum(c).over(w)) / F.count(c).over(w)


def year_to_date(c: str, keys=ENTITY) -> Column:
    w = Window.partitionBy(*keys, F.floor(F.col("period_key") / 100)).orderBy("period_key")
    return F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0))


def running_total(c: str, keys=ENTITY) -> Column:
    return F.sum(c).over(by_period(keys).rowsBetween(Window.unboundedPreceding, 0))


def seasonal_index(c: str, years: int = 5, keys=ENTITY) -> Column:
    """Value over the mean of the same calendar month in the last `years` rows."""
    w = Window.partitionBy(*keys, F.col("period_key") % 100).orderBy("period_key").rowsBetween(1 - years, 0)
    return ratio(F.col(c), dbl(F.sum(c).over(w)) / F.count(c).over(w), 6)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by `order`, as an aggregate: partial results combine before the shuffle, so a hot key stays cheap."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(first).select(*keys, "_r.*")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(last).select(*keys, "_r.*")
