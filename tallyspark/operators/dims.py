"""Conformed dimensions with integer keys, calendars and hierarchies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.periods import fiscal_period_of, fiscal_quarter_of, fiscal_year_of, period_of_date, prior_period_key, prior_year_key
from ..plans import constants as K
from ..session import cut_lineage

UNKNOWN = -1


BUCKET_DIGITS = 3


def surrogate_key(df: DataFrame, natural: list[str], out: str, after: int = 0) -> DataFrame:
    """Dense integer keys from `after` + 1 on, in the order of the natural key's hash, without sorting everything in one task.

    Rows are numbered inside buckets of the hash's first digits; each bucket starts after the rows of the buckets before it. The number of
    buckets is bounded by the digits, and does not change the numbers.
    """
    buckets = df.withColumn("_h", F.md5(F.concat_ws("|", *natural))).withColumn("_b", F.substring("_h", 1, BUCKET_DIGITS))
    counts = buckets.groupBy("_b").agg(F.count("*").alias("_n"))
    start = counts.select("_b", (F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_s"))
    number = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *natural))
    return buckets.withColumn("_r", number).join(start, "_b").withColumn(out, F.col("_s") + F.col("_r") + F.lit(after).cast("bigint")).drop("_h", "_b", "_r", "_s")


def issue_keys(issued: DataFrame | None, members: DataFrame, natural: list[str], out: str) -> DataFrame:
    """The dimension after a load: issued members keep their keys and take the load's attributes, new ones are numbered after the largest
    key so far, and members that the load lacks stay as they are."""
    if issued is None:
        return surrogate_key(members, natural, out)
    issued = cut_lineage(issued, "issued-keys")
    largest = issued.agg(F.max(out)).first()[0] or 0
    keys = issued.select(*natural, out)
    new = surrogate_key(members.join(keys, natural, "left_anti"), natural, out, largest)
    known = members.join(keys, natural)
    gone = issued.join(members.select(*natural), natural, "left_anti")
    return new.unionByName(known).unionByName(gone.select(*new.columns))


def resolve(fact: DataFrame, dim: DataFrame, on: dict[str, str], key: str) -> DataFrame:
    """Surrogate key of a dimension; a missing member gets -1."""
    d = dim.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_d{i}") for i, c in enumerate(on.values())])
    cond = reduce(lambda a, x: a & x, [F.col(f) == F.col(f"_d{i}") for i, f in enumerate(on)])
    return fact.join(d, cond, "left").withColumn(key, F.coalesce("_k", F.lit(UNKNOWN))).drop("_k", *[f"_d{i}" for i in range(len(on))])


def easter_sunday(year: Column) -> Column:
    """Date of Easter in the Gregorian calendar, by the century-safe integer rule."""
    div = lambda a, b: F.floor(a / b).cast("int")
    a, b, c = year % 19, div(year, 100), year % 100
    epact = (19 * a + b - div(b, 4) - div(b - div(b + 8, 25) + 1, 3) + 15) % 30
    weekday = (32 + 2 * (b % 4) + 2 * div(c, 4) - epact - c % 4) % 7
    days = epact + weekday - 7 * div(a + 11 * epact + 22 * weekday, 451)
    return F.date_add(F.make_date(year, F.lit(3), F.lit(22)), days.cast("int"))


def holiday_flag(day: Column) -> Column:
    fixed = [(F.month(day) == m) & (F.dayofmonth(day) == d) for m, d in K.FIXED_HOLIDAYS]
    easter = easter_sunday(F.year(day))
    return reduce(lambda a, x: a | x, fixed + [day == F.date_add(easter, n) for n in K.DAYS_AFTER_EASTER])


HUNGARIAN_MONTHS = ["január", "február", "március", "április", "május", "június", "július", "augusztus", "szeptember", "október",
                    "november", "december"]
ENGLISH_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def calendar_of(dates: DataFrame, column: str) -> DataFrame:
    """One row per day of the full years that the data covers."""
    span = dates.agg(F.make_date(F.year(F.min(column)), F.lit(1), F.lit(1)).alias("a"), F.make_date(F.year(F.max(column)), F.lit(12), F.lit(31)).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("full_date"))


def with_trading_days(calendar: DataFrame) -> DataFrame:
    """Weekdays that are no holiday, numbered inside their month and counted per month."""
    d = F.col("full_date")
    month = Window.partitionBy("period_key")
    trading = ((F.weekday(d) < 5) & ~holiday_flag(d)).cast("int")
    return calendar.withColumn("period_key", period_of_date("full_date")).withColumn("is_trading_day", trading == 1).withColumns({
        "trading_day_number": F.sum(trading).over(month.orderBy("full_date").rowsBetween(Window.unboundedPreceding, 0)).cast("int"),
        "trading_days_in_month": F.sum(trading).over(month).cast("int"),
    })


def dim_date(calendar: DataFrame, start_month: int = 1) -> DataFrame:
    d = F.col("full_date")
    name = lambda months: F.element_at(F.array(*[F.lit(m) for m in months]), F.month(d))
    return with_trading_days(calendar).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"), "full_date", F.year(d).alias("calendar_year"), F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("calendar_month"), name(HUNGARIAN_MONTHS).alias("month_name_hu"), name(ENGLISH_MONTHS).alias("month_name_en"),
        F.weekofyear(d).alias("iso_week"), (F.weekday(d) + 1).alias("iso_weekday"), (d == F.last_day(d)).alias("is_month_end"),
        (d == F.make_date(F.year(d), F.lit(12), F.lit(31))).alias("is_year_end"), fiscal_year_of(d, start_month).alias("fiscal_year"),
        fiscal_period_of(d, start_month).alias("fiscal_period"), fiscal_quarter_of(d, start_month).alias("fiscal_quarter"), "period_key",
        prior_period_key("period_key").alias("prior_period_key"), prior_year_key("period_key").alias("prior_year_period_key"),
        holiday_flag(d).alias("is_holiday"), "is_trading_day", "trading_day_number", "trading_days_in_month")


def budget_per_trading_day(budget: DataFrame, calendar: DataFrame) -> DataFrame:
    """Monthly budget spread over the trading days of its month."""
    days = with_trading_days(calendar).where("is_trading_day").select("period_key", "full_date", "trading_days_in_month")
    daily = F.round(F.col("budget_amount").cast("double") / F.col("trading_days_in_month") * F.lit(1 + 1e-12), 2)
    return budget.join(days, "period_key").withColumn("daily_budget", daily)


def entity_hierarchy(entities: DataFrame) -> DataFrame:
    """Every (ancestor, descendant) with its depth, by pointer doubling: `jump` leads every entity 2 ** k levels up, and pairs nearer than that are
    carried on by it to those nearer than twice that. So the joins grow with the logarithm of the depth. Raises on a cycle, naming
    entities on it."""
    size = entities.count()
    jump = entities.where("parent_key IS NOT NULL").select(F.col("entity_key").alias("_from"), F.col("parent_key").alias("_to"))
    jump = cut_lineage(jump.join(entities.select(F.col("entity_key").alias("_to")), "_to", "left_semi"), "hierarchy-jump")
    pairs = entities.select(F.col("entity_key").alias("ancestor_key"), F.col("entity_key").alias("descendant_key"), F.lit(0).alias("depth"))
    reach = 1
    while not jump.isEmpty():
        if reach >= size:  # a walk as long as there are entities has come round
            ring = [str(r[0]) for r in jump.select("_to").distinct().sort("_to").limit(20).collect()]
            raise ValueError(f"hierarchy has a cycle through {', '.join(ring)}")
        further = pairs.join(jump, F.col("ancestor_key") == F.col("_from")).select(F.col("_to").alias("ancestor_key"), "descendant_key", (F.col("depth") + reach).alias("depth"))
        pairs = cut_lineage(pairs.unionByName(further), "hierarchy-pairs")
        again = jump.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"))
        jump = cut_lineage(jump.join(again, "_to").select("_from", F.col("_next").alias("_to")), "hierarchy-jump")
        reach *= 2
    return pairs
