"""Financial ratios per entity and month. Each function adds named columns to a frame that already holds their inputs."""

from pyspark.sql import DataFrame, functions as F

from ..functions.money import dbl, ratio, rnd
from .statements import KEY, SCOPED
from . import windows as W

SCOPE_KEYS = ("entity_key", "consolidation_scope")
TAX_RATE = 0.09


def with_scopes(df: DataFrame) -> DataFrame:
    """Balance-sheet frames know no scope; repeat them for both so that joins use the full key."""
    return df.withColumn("consolidation_scope", F.explode(F.array(F.lit("entity"), F.lit("group"))))


def profitability(pl: DataFrame, buckets: DataFrame) -> DataFrame:
    c = F.col
    bs = buckets.select(*KEY, "total_assets", "total_equity", "total_debt", "cash").withColumns(
        {"prior_total_assets": W.previous("total_assets"), "prior_total_equity": W.previous("total_equity")})
    joined = pl.join(bs, KEY, "left")
    mean = lambda x: dbl(c(f"total_{x}") + c(f"prior_total_{x}")) / 2
    capital = c("total_equity") + c("total_debt") - c("cash")
    return joined.select(
        *SCOPED, "revenue", "revenue_eur", "gross_profit", "gross_margin_pct", "ebitda", "ebitda_margin_pct", "net_profit",
        ratio(c("net_profit"), c("revenue"), 4, 100).alias("net_profit_margin_pct"),
        ratio(c("net_profit"), mean("assets"), 4, 100).alias("roa_pct"), ratio(c("net_profit"), mean("equity"), 4, 100).alias("roe_pct"),
        "total_assets", "total_equity", "total_debt", "cash", (c("total_debt") - c("cash")).alias("net_debt"),
        capital.alias("invested_capital"),
        ratio(dbl("ebit") * (1 - TAX_RATE), capital, 4, 100).alias("roic_pct"),
        "revenue_budget", "revenue_variance", "revenue_variance_pct", "revenue_py", "revenue_yoy", "revenue_yoy_pct",
    )


def returns_moving_average(components: DataFrame, wide: DataFrame) -> DataFrame:
    """Return on assets and equity against the mean of the last two balances, as fractions; the first month uses itself."""
    c = F.col
    joined = components.join(wide.select(*KEY, "total_assets", "total_equity"), KEY, "left")
    return joined.withColumns({"mean_assets": W.moving_average("total_assets"), "mean_equity": W.moving_average("total_equity")}).select(
        *KEY, ratio(c("net_profit"), c("mean_assets"), 6).alias("return_on_assets"),
        ratio(c("net_profit"), c("mean_equity"), 6).alias("return_on_equity"))


def staff_cost_ratio(components: DataFrame) -> DataFrame:
    return components.select(*KEY, ratio(F.col("opex_personnel"), F.col("revenue"), 4, 100).alias("staff_cost_ratio_pct"))


def rule_of_40(components: DataFrame, cashflow: DataFrame) -> DataFrame:
    c = F.col
    fcf = cashflow.where("consolidation_scope = 'entity'").select(*KEY, "free_cash_flow")
    value = c("revenue_yoy_ratio") * 100 + dbl(F.coalesce(c("free_cash_flow"), F.lit(0))) / dbl("revenue") * 100
    return components.join(fcf, KEY, "left").select(
        *KEY, F.when(c("revenue_yoy_ratio").isNotNull() & (c("revenue") != 0), rnd(value, 4)).alias("rule_of_40"))


def liquidity(buckets: DataFrame, pl: DataFrame, cashflow: DataFrame) -> DataFrame:
    c = F.col
    flows = pl.select(*SCOPED, "revenue", "cogs", "ebit", "ebitda", "net_financial_items").withColumn(
        "ebitda_ltm", W.trailing_rows("ebitda", 12, SCOPE_KEYS))
    cf = cashflow.select(*SCOPED, "operating_cash_flow", "free_cash_flow", "capex")
    joined = with_scopes(buckets).join(flows, SCOPED, "left").join(cf, SCOPED, "left")
    net_debt = c("total_debt") - c("cash")
    per_day = lambda balance, flow: dbl(balance) / (dbl(flow) / 30.0)
    return joined.select(
        *SCOPED,
        ratio(c("current_assets"), c("current_liabilities"), 4).alias("current_ratio"),
        ratio(c("current_assets") - c("inventory"), c("current_liabilities"), 4).alias("quick_ratio"),
        F.when(c("revenue") != 0, rnd(per_day("trade_receivables", "revenue"), 1)).alias("dso_days"),
        F.when(c("cogs") != 0, rnd(per_day("trade_payables", "cogs"), 1)).alias("dpo_days"),
        F.when(c("cogs") != 0, rnd(per_day("inventory", "cogs"), 1)).alias("dio_days"),
        F.when((c("revenue") != 0) & (c("cogs") != 0), rnd(
            per_day("trade_receivables", "revenue") + per_day("inventory", "cogs") - per_day("trade_payables", "cogs"), 1)
        ).alias("cash_conversion_cycle_days"),
        net_debt.alias("net_debt"), "ebitda_ltm", ratio(net_debt, c("ebitda_ltm"), 2).alias("net_debt_ebitda"),
        F.when(c("net_financial_items") < 0, ratio(c("ebit"), F.abs(c("net_financial_items")), 2)).alias("interest_coverage"),
        ratio(c("total_equity"), c("total_assets"), 2, 100).alias("equity_ratio_pct"),
        ratio(net_debt, net_debt + c("total_equity"), 2, 100).alias("gearing_ratio_pct"),
        "current_assets", "current_liabilities", "trade_receivables", "inventory", "trade_payables", "total_debt", "total_equity",
        "total_assets", "cash", "operating_cash_flow", "free_cash_flow", "capex",
        ratio(F.abs(c("capex")), c("revenue"), 2, 100).alias("capex_intensity_pct"),
    )


def liquidity_annualised(wide: DataFrame, components: DataFrame, cashflow: DataFrame) -> DataFrame:
    """Annualised day counts, coverage and turnover ratios on the wide statement layout."""
    c = F.col
    pl = components.select(*KEY, "revenue", "cogs", "gross_profit", "ebitda", "ebitda_ytd", "ebitda_py", "ebit", "net_interest_expense")
    cf = cashflow.where("consolidation_scope = 'entity'").select(*KEY, F.least(c("net_debt_change"), F.lit(0)).alias("debt_repayments"))
    j = wide.join(pl, KEY, "left").join(cf, KEY, "left")
    days = lambda balance, flow: dbl(balance) / (dbl(flow) * 12 / 365.0)
    debt_base = F.coalesce(dbl("ebitda_ytd"), dbl("ebitda_py"), dbl("ebitda") * 12)
    service = F.abs(F.coalesce(dbl("debt_repayments"), F.lit(0.0))) + F.coalesce(dbl("net_interest_expense"), F.lit(0.0))
    stock = F.coalesce(dbl(c("inventory") + c("inventory_py")) / 2, dbl("inventory"))
    return j.select(
        *KEY,
        F.when(c("revenue") != 0, rnd(days("trade_receivables", "revenue"), 4)).alias("dso_days"),
        F.when(c("cogs") != 0, rnd(days("inventory", "cogs"), 4)).alias("dio_days"),
        F.when(c("cogs") != 0, rnd(days("trade_payables", "cogs"), 4)).alias("dpo_days"),
        F.when((c("revenue") != 0) & (c("cogs") != 0), rnd(
            days("trade_receivables", "revenue") + days("inventory", "cogs") - days("trade_payables", "cogs"), 4)).alias("cash_conversion_cycle"),
        ratio(c("net_debt"), debt_base, 4).alias("net_debt_to_ebitda"),
        ratio(c("ebit"), c("net_interest_expense"), 4).alias("interest_coverage"),
        F.when(service > 0, ratio(c("ebitda"), service, 4)).alias("debt_service_coverage"),
        ratio(c("total_equity"), c("total_assets"), 4, 100).alias("equity_ratio_pct"),
        ratio(c("net_debt"), c("net_debt") + c("total_equity"), 4).alias("gearing_ratio"),
        ratio(dbl("cogs") * 12, stock, 4).alias("inventory_turnover"), ratio(dbl("gross_profit") * 12, stock, 4).alias("gmroi"),
    )


def days_trailing_quarter(buckets: DataFrame, pl: DataFrame) -> DataFrame:
    """Receivable and payable days against the last three calendar months over 90 days."""
    c = F.col
    flows = pl.where("consolidation_scope = 'entity'").select(
        *KEY, W.trailing_months("revenue", 3).alias("revenue_3m"), W.trailing_months("cogs", 3).alias("cogs_3m"))
    return buckets.join(flows, KEY, "left").select(
        *KEY, ratio(c("trade_receivables"), dbl("revenue_3m") / 90, 4).alias("dso_days"),
        ratio(c("trade_payables"), dbl("cogs_3m") / 90, 4).alias("dpo_days"))


def cash_kpis(cashflow: DataFrame, pl: DataFrame, buckets: DataFrame) -> DataFrame:
    c = F.col
    cash = buckets.select(*KEY, c("cash").alias("cash_and_equivalents"), W.previous("cash").alias("prior_cash_balance"))
    ltm = {f"{short}_ltm": W.trailing_rows(name, 12, SCOPE_KEYS) for short, name in
           (("ocf", "operating_cash_flow"), ("fcf", "free_cash_flow"), ("capex", "capex"))}
    j = cashflow.withColumns(ltm).join(pl.select(*SCOPED, "revenue", "ebitda"), SCOPED, "left").join(cash, KEY, "left")
    ocf, burning = c("operating_cash_flow"), c("operating_cash_flow") < 0
    zero = F.lit(0).cast("decimal(28,2)")
    return j.select(
        *SCOPED, "operating_cash_flow", "investing_cash_flow", "financing_cash_flow", "net_cash_movement", "free_cash_flow", "capex",
        ratio(ocf, c("revenue"), 2, 100).alias("ocf_margin_pct"), ratio(F.abs(c("capex")), c("revenue"), 2, 100).alias("capex_intensity_pct"),
        ratio(ocf, c("ebitda"), 2, 100).alias("cf_conversion_pct"),
        F.when(burning, F.abs(ocf)).otherwise(zero).alias("monthly_burn_rate"),
        F.when(burning, ratio(c("cash_and_equivalents"), F.abs(ocf), 1)).alias("cash_runway_months"),
        F.when(ocf > 0, ratio(F.abs(c("capex")), ocf, 2, 100)).alias("reinvestment_rate_pct"),
        F.when(c("free_cash_flow") < 0, F.abs(c("free_cash_flow"))).alias("cash_burn_rate_fcf"),
        ratio(c("free_cash_flow"), c("revenue"), 4, 100).alias("fcf_margin_pct"),
        "ocf_ltm", "fcf_ltm", "capex_ltm", ratio(c("fcf_ltm"), c("revenue"), 2, 100).alias("fcf_margin_ltm_pct"),
        "cash_and_equivalents", "prior_cash_balance",
        (c("cash_and_equivalents") - F.coalesce("prior_cash_balance", zero)).alias("cash_movement_period"),
    )
