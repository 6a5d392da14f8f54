"""Actual against budget and prior year by entity, cost centre and line."""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import ratio
from .accounts import map_accounts

GRAIN = ["period_key", "entity_key", "cost_centre", "pl_line_item"]


def line_actuals(cost_balance: DataFrame, accounts: DataFrame, no_centre: str | None = None) -> DataFrame:
    """Signed actuals per line; `no_centre` names the cost-centre value that means overhead (null)."""
    centre = F.col("cost_centre") if no_centre is None else F.when(F.col("cost_centre") != no_centre, F.col("cost_centre"))
    return (
        map_accounts(cost_balance, accounts).where("pl_line_item IS NOT NULL")
        .groupBy("period_key", "entity_key", centre.alias("cost_centre"), "pl_line_item").agg(F.sum("signed").cast("decimal(28,2)").alias("actual_amount"))
    )


def variance_analysis(actuals: DataFrame, growth: str = "1.05", breach: float = 0.1) -> DataFrame:
    """The cost centre may be null on both sides, so last year joins null-safely."""
    c = F.col
    last = actuals.select((c("period_key") + 100).cast("int").alias("_p"), c("entity_key").alias("_e"), c("cost_centre").alias("_c"),
                          c("pl_line_item").alias("_l"), c("actual_amount").alias("prior_year_amount"))
    j = actuals.join(last, (c("period_key") == c("_p")) & (c("entity_key") == c("_e")) & (c("pl_line_item") == c("_l"))
                     & c("cost_centre").eqNullSafe(c("_c")), "left").drop("_p", "_e", "_c", "_l")
    j = j.withColumn("budget_amount", (c("prior_year_amount") * F.lit(growth).cast("decimal(4,2)")).cast("decimal(28,2)"))
    share = ratio(c("actual_amount") - c("budget_amount"), F.abs(c("budget_amount")), 4)
    ytd = Window.partitionBy("entity_key", "cost_centre", "pl_line_item", F.floor(c("period_key") / 100)).orderBy("period_key").rowsBetween(
        Window.unboundedPreceding, 0)
    return j.select(
        *GRAIN, "actual_amount", "budget_amount", "prior_year_amount", (c("actual_amount") - c("budget_amount")).alias("variance_amount"),
        share.alias("variance_ratio"),
        F.coalesce(F.abs("actual_amount") > F.abs("budget_amount"), F.lit(False)).alias("is_over_budget"),
        F.coalesce(F.abs(share) > breach, F.lit(False)).alias("alert_threshold_breached"),
        (c("actual_amount") - c("prior_year_amount")).alias("yoy_variance_amount"),
        ratio(c("actual_amount") - c("prior_year_amount"), F.abs(c("prior_year_amount")), 4).alias("yoy_variance_ratio"),
        F.sum("actual_amount").over(ytd).alias("actual_ytd"), F.sum("budget_amount").over(ytd).alias("budget_ytd"),
        F.sum("prior_year_amount").over(ytd).alias("prior_year_ytd"),
    )
