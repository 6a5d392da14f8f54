"""Currency conversion. Rates are quoted as `rate_to_huf` per (rate_date, currency_code).

As-of lookups never join on an inequality: the rate table is first stretched to one row per currency and calendar day, which is
bounded by the calendar, and then joined on equality. Spark broadcasts it when its written size is small enough.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import cents, cents_over, cents_times, from_cents, millionths
from ..functions.periods import period_end_date

EUR_FALLBACK = 400


def densify(rates: DataFrame, until: str) -> DataFrame:
    """Every calendar day from a currency's first quote to `until`, carrying the last quote over the gaps."""
    following = F.lead("rate_date").over(Window.partitionBy("currency_code").orderBy("rate_date"))
    last_day = F.coalesce(F.date_sub(following, 1), F.greatest(F.to_date(F.lit(until)), F.col("rate_date")))
    return rates.withColumn("last_day", last_day).select(
        "currency_code", F.explode(F.sequence("rate_date", "last_day")).alias("day"), "rate_date", "rate_to_huf")


def daily_fixing(rates: DataFrame) -> DataFrame:
    """Calendar spine between the first and last quote of each currency with the gaps filled forward."""
    span = rates.groupBy("currency_code").agg(F.min("rate_date").alias("a"), F.max("rate_date").alias("b"))
    spine = span.select("currency_code", F.explode(F.sequence("a", "b")).alias("day"))
    carry = Window.partitionBy("currency_code").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return spine.join(rates.withColumnRenamed("rate_date", "day"), ["currency_code", "day"], "left").select(
        "currency_code", "day", F.last("rate_to_huf", ignorenulls=True).over(carry).alias("rate_to_huf"),
        F.col("rate_to_huf").isNull().alias("is_carried"))


def latest_rates(rates: DataFrame) -> DataFrame:
    return rates.groupBy("currency_code").agg(F.max_by("rate_to_huf", "rate_date").alias("latest_rate"))


def attach_asof(df: DataFrame, rates_daily: DataFrame, rates: DataFrame, day: str, currency: str, out: str = "rate_to_huf") -> DataFrame:
    """Last quote on or before the day; days before the first quote take the latest quote of the currency."""
    daily = rates_daily.select(F.col("currency_code").alias("_c"), F.col("day").alias("_d"), F.col("rate_to_huf").alias("_r"))
    latest = latest_rates(rates).select(F.col("currency_code").alias("_lc"), F.col("latest_rate").alias("_l"))
    return (
        df.join(daily, (F.col(currency) == F.col("_c")) & (F.col(day) == F.col("_d")), "left")
        .join(latest, F.col(currency) == F.col("_lc"), "left")
        .withColumn(out, F.coalesce("_r", "_l")).drop("_c", "_d", "_r", "_lc", "_l")
    )


def times(amount_col, rate) -> Column:
    """Amount times rate, rounded to cents without a detour over doubles."""
    return from_cents(cents_times(cents(amount_col), millionths(rate)))


def over(amount_col, rate) -> Column:
    """Amount divided by rate, rounded to cents without a detour over doubles."""
    return from_cents(cents_over(cents(amount_col), millionths(rate)))


def crossed(amount_col, own: Column, target: Column) -> Column:
    """Amount times one rate over another, rounded once."""
    a, digits = cents(amount_col).cast("decimal(19,0)"), "decimal(38,0)"
    product = (F.abs(a) * millionths(own).cast("decimal(16,0)")).cast(digits)
    by = millionths(target).cast("decimal(16,0)")
    return from_cents(F.sign(a).cast("bigint") * F.call_function("div", (2 * product + by).cast(digits), F.when(by != 0, 2 * by)))


def convert_exact_date(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Amounts in EUR and home currency at the quote of the very posting date, with fixed fallbacks and flags."""
    eur = rates.where("currency_code = 'EUR'").select(F.col("rate_date").alias("_ed"), F.col("rate_to_huf").alias("_er"))
    fcy = rates.select(F.col("rate_date").alias("_fd"), F.col("currency_code").alias("_fc"), F.col("rate_to_huf").alias("_fr"))
    home = F.col("currency_code").isNull() | (F.col("currency_code") == "HUF")
    return (
        df.join(eur, F.col("posting_date") == F.col("_ed"), "left")
        .join(fcy, (F.col("posting_date") == F.col("_fd")) & (F.col("currency_code") == F.col("_fc")), "left")
        .withColumns({
            "huf_to_eur_rate": 1 / F.coalesce(F.col("_er").cast("double"), F.lit(float(EUR_FALLBACK))),
            "used_fallback_eur_rate": F.col("_ed").isNull(),
            "used_fallback_fcy_rate": ~home & F.col("_fd").isNull(),
        })
        .withColumns({
            "net_eur": over("net", F.coalesce("_er", F.lit(EUR_FALLBACK).cast("decimal(16,6)"))),
            "net_lcy_fx_adjusted": F.when(home, F.col("net")).otherwise(
                times(F.col("debit_fcy") - F.col("credit_fcy"), F.coalesce("_fr", F.lit(1).cast("decimal(16,6)")))),
        })
        .drop("_ed", "_er", "_fd", "_fc", "_fr")
    )


def fcy_to_huf(df: DataFrame, rates_daily: DataFrame, amount_col: str, day: str = "posting_date") -> DataFrame:
    """As-of rate times amount; home-currency rows pass through, unknown currencies count one to one."""
    home = F.col("currency_code").isNull() | (F.col("currency_code") == "HUF")
    daily = rates_daily.select(F.col("currency_code").alias("_c"), F.col("day").alias("_d"), F.col("rate_to_huf").alias("_r"))
    return (
        df.join(daily, (F.col("currency_code") == F.col("_c")) & (F.col(day) == F.col("_d")), "left")
        .withColumn("amount_huf", F.when(home, F.col(amount_col).cast("decimal(18,2)")).otherwise(
            times(amount_col, F.coalesce("_r", F.lit(1).cast("decimal(16,6)")))))
        .drop("_c", "_d", "_r")
    )


def period_end_rates(periods: DataFrame, rates_daily: DataFrame, rates: DataFrame) -> DataFrame:
    """Revaluation rate of each (period, currency): the quote valid on the last day of the month."""
    return attach_asof(periods.withColumn("period_end", period_end_date("period_key")), rates_daily, rates, "period_end", "currency_code")


def cross_to_eur(df: DataFrame, rates_daily: DataFrame, amount_col: str, day: str = "posting_date") -> DataFrame:
    """Foreign amount to EUR through the HUF cross rate, both legs as-of the same day."""
    own = rates_daily.select(F.col("currency_code").alias("_c"), F.col("day").alias("_d"), F.col("rate_to_huf").alias("_r"))
    eur = rates_daily.where("currency_code = 'EUR'").select(F.col("day").alias("_ed"), F.col("rate_to_huf").alias("_er"))
    own_rate = F.when(F.col("currency_code") == "HUF", F.lit(1).cast("decimal(16,6)")).otherwise(F.col("_r"))
    return (
        df.join(own, (F.col("currency_code") == F.col("_c")) & (F.col(day) == F.col("_d")), "left")
        .join(eur, F.col(day) == F.col("_ed"), "left")
        .withColumn("rate_to_eur", own_rate.cast("double") / F.col("_er").cast("double"))
        .withColumn("amount_eur", crossed(amount_col, own_rate, F.col("_er")))
        .drop("_c", "_d", "_r", "_ed", "_er")
    )


def rate_coverage(rates: DataFrame, days_before: int, days_after: int) -> DataFrame:
    """Every (currency, day) for which a quote exists in [day - days_before, day + days_after]."""
    return rates.select("currency_code", F.explode(F.sequence(
        F.date_sub("rate_date", days_after), F.date_add("rate_date", days_before))).alias("day")).distinct()


def without_rate(df: DataFrame, rates: DataFrame, days_before: int = 3, days_after: int = 1) -> DataFrame:
    """Foreign-currency rows with no quote near their posting date."""
    covered = rate_coverage(rates, days_before, days_after).select(F.col("currency_code").alias("_c"), F.col("day").alias("_d"))
    return df.where(F.col("currency_code") != "HUF").join(
        covered, (F.col("currency_code") == F.col("_c")) & (F.col("posting_date") == F.col("_d")), "left_anti")
