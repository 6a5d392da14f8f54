"""Project results. Income is turned positive, costs are taken as posted."""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import ratio, sum_where

GRAIN = ["period_key", "entity_key", "project"]
LABOUR = ["Labour", "Payroll", "Salary"]


def project_actuals(cost_balance: DataFrame, accounts: DataFrame) -> DataFrame:
    l1, l2 = F.col("l1_category"), F.col("l2_subcategory")
    labour = F.coalesce(l2.rlike("|".join(LABOUR)), F.lit(False))
    cost = l1.isin("COGS", "OPEX")
    return cost_balance.where("project IS NOT NULL").join(accounts, "account_code").groupBy(*GRAIN).agg(
        sum_where(l1 == "Revenue", -F.col("net")).alias("project_revenue"), sum_where(l1 == "COGS", "net").alias("project_cogs"),
        sum_where(cost & labour, "net").alias("project_labour_cost"), sum_where((l1 == "OPEX") & ~labour, "net").alias("project_nonlabour_cost"),
        sum_where(cost, "net").alias("project_total_cost"), sum_where(l1 == "Revenue", -F.col("net_eur")).alias("project_revenue_eur"),
        sum_where(cost, "net_eur").alias("project_total_cost_eur"), sum_where(F.col("account_type") == "Expense", "net").alias("project_expense"),
        F.sum("postings").alias("transaction_count"))


def project_ytd(actuals: DataFrame) -> DataFrame:
    w = Window.partitionBy("entity_key", "project", "fiscal_year").orderBy("period_key").rowsBetween(Window.unboundedPreceding, 0)
    return actuals.withColumn("fiscal_year", F.floor(F.col("period_key") / 100).cast("int")).withColumns({
        f"ytd_{n}": F.sum(f"project_{n}").over(w) for n in ("revenue", "total_cost", "labour_cost")})


def budgets_from_last_year(actuals: DataFrame, growth: str = "1.02") -> DataFrame:
    return actuals.groupBy((F.floor(F.col("period_key") / 100) + 1).cast("int").alias("fiscal_year"), "entity_key", "project").agg(
        (F.sum("project_total_cost") * F.lit(growth).cast("decimal(4,2)")).cast("decimal(28,2)").alias("project_budget"))


def project_overrun(ytd: DataFrame, budgets: DataFrame, tolerance: str = "1.05") -> DataFrame:
    c = F.col
    return ytd.join(budgets, ["fiscal_year", "entity_key", "project"], "left").withColumns({
        "ytd_cost_vs_budget": c("ytd_total_cost") - F.coalesce(c("project_budget"), F.lit(0).cast("decimal(28,2)")),
        "ytd_cost_overrun_pct": ratio(c("ytd_total_cost") - c("project_budget"), F.abs(c("project_budget")), 2, 100),
        "is_cost_overrun": F.coalesce((c("project_budget") > 0) & (c("ytd_total_cost") > c("project_budget") * F.lit(tolerance).cast("decimal(4,2)")), F.lit(False)),
    })


def project_margin(actuals: DataFrame) -> DataFrame:
    c = F.col
    gross, net = c("project_revenue") - c("project_cogs"), c("project_revenue") - c("project_expense")
    return actuals.select(
        *GRAIN, "project_revenue", c("project_cogs").alias("project_direct_cost"), c("project_expense").alias("project_total_cost"),
        gross.alias("project_gross_profit"), net.alias("project_net_contribution"), ratio(gross, c("project_revenue"), 4, 100).alias("project_gross_margin_pct"),
        ratio(net, c("project_revenue"), 4, 100).alias("project_net_margin_pct"), "transaction_count")


def kpi_project(actuals: DataFrame, budgets: DataFrame) -> DataFrame:
    c = F.col
    return project_overrun(project_ytd(actuals.drop("transaction_count", "project_expense")), budgets).withColumns({
        "project_gross_profit": c("project_revenue") - c("project_cogs"),
        "project_gross_margin_pct": ratio(c("project_revenue") - c("project_cogs"), c("project_revenue"), 2, 100),
        "labour_cost_share_pct": ratio(c("project_labour_cost"), c("project_total_cost"), 2, 100),
        "ytd_project_profit": c("ytd_revenue") - c("ytd_total_cost"),
    })
