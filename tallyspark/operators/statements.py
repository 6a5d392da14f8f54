"""Profit and loss, balance sheet and indirect cash flow from monthly movements.

Every statement is one grouped pass with conditional sums; scopes are unfolded after the aggregation, not scanned twice.
"""

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import ratio, sum_where
from .accounts import under, under_any
from .staging import signed_balance

KEY = ["period_key", "entity_key"]
SCOPED = KEY + ["consolidation_scope"]
PL_LINES = ["revenue", "cogs", "opex_total", "depreciation_amortisation", "financial_income", "financial_expense", "tax_expense",
            "revenue_eur"]


def _line_conditions():
    l1, line = F.col("l1_category"), F.col("pl_line_item")
    return {
        "revenue": (l1 == "Revenue", "signed"), "cogs": (l1 == "COGS", "signed"), "opex_total": (l1 == "OPEX", "signed"),
        "depreciation_amortisation": (line == "DA", "signed"), "financial_income": (line == "Fin_Income", "signed"),
        "financial_expense": (line == "Fin_Expense", "signed"), "tax_expense": (line == "Tax", "signed"),
        "revenue_eur": (l1 == "Revenue", "net_eur"),
    }


def pl_actuals(mapped: DataFrame, scopes=("entity", "group")) -> DataFrame:
    """P&L lines per period and entity: scope `entity` has all postings, `group` leaves intercompany postings out."""
    outside = ~F.col("is_intercompany")
    sums = []
    for name, (cond, value) in _line_conditions().items():
        sums += [sum_where(F.coalesce(cond, F.lit(False)), value).alias(f"entity_{name}"),
                 sum_where(F.coalesce(cond, F.lit(False)) & outside, value).alias(f"group_{name}")]
    unfolded = F.array(*[F.struct(F.lit(s).alias("consolidation_scope"), *[F.col(f"{s}_{n}").alias(n) for n in PL_LINES]) for s in scopes])
    return mapped.groupBy(*KEY).agg(*sums).select(*KEY, F.explode(unfolded).alias("s")).select(*KEY, "s.*")


def budget_by_line(budget: DataFrame, accounts: DataFrame, version: str = "ORIGINAL_BUDGET") -> DataFrame:
    return (
        budget.where(F.col("budget_version") == version).join(accounts, "account_code")
        .groupBy(*KEY, "account_code", "l1_category", "pl_line_item").agg(F.sum("budget_amount").alias("budget_amount"))
    )


def budget_totals(by_line: DataFrame) -> DataFrame:
    l1, line = F.col("l1_category"), F.coalesce("pl_line_item", F.lit(""))
    return by_line.groupBy(*KEY).agg(
        sum_where(l1 == "Revenue", "budget_amount").alias("revenue_budget"), sum_where(l1 == "COGS", "budget_amount").alias("cogs_budget"),
        sum_where(l1 == "OPEX", "budget_amount").alias("opex_budget"),
        sum_where((l1 == "OPEX") & (line != "DA"), "budget_amount").alias("_cash_opex_budget"),
    )


def add_results(pl: DataFrame) -> DataFrame:
    """Subtotals and margins; a margin without revenue is 0."""
    gp = F.col("revenue") - F.col("cogs")
    ebit = gp - F.col("opex_total")
    ebitda = ebit + F.col("depreciation_amortisation")
    items = F.col("financial_income") - F.col("financial_expense")
    return pl.withColumns({
        "gross_profit": gp, "gross_margin_pct": ratio(gp, F.col("revenue"), 4, 100, otherwise=0),
        "ebit": ebit, "ebitda": ebitda, "ebitda_margin_pct": ratio(ebitda, F.col("revenue"), 4, 100, otherwise=0),
        "net_financial_items": items, "net_profit": ebit + items - F.col("tax_expense"),
    })


def prior_year(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Columns of the same period one year earlier, joined on the shifted integer period."""
    shifted = df.select(*[(F.col("period_key") + 100).cast("int").alias(k) if k == "period_key" else F.col(k) for k in keys],
                        *[F.col(a).alias(b) for a, b in columns.items()])
    return df.join(shifted, keys, "left")


def pl_monthly(actuals: DataFrame, by_line: DataFrame) -> DataFrame:
    """Both scopes with subtotals, the entity's original budget and last year's revenue of the same scope."""
    totals = budget_totals(by_line).select(*KEY, "revenue_budget", "cogs_budget")
    joined = prior_year(actuals.join(totals, KEY, "left"), SCOPED, {"revenue": "revenue_py"})
    return add_results(joined).withColumns({
        "revenue_variance": F.col("revenue") - F.col("revenue_budget"),
        "revenue_variance_pct": ratio(F.col("revenue") - F.col("revenue_budget"), F.col("revenue_budget"), 4, 100),
        "revenue_yoy": F.col("revenue") - F.col("revenue_py"),
        "revenue_yoy_pct": ratio(F.col("revenue") - F.col("revenue_py"), F.col("revenue_py"), 4, 100),
    })


def pl_components(mapped: DataFrame, by_line: DataFrame) -> DataFrame:
    """Component layout: operating cost split, margins as fractions, budget, prior year and year-to-date columns."""
    l1, l2, line = F.col("l1_category"), F.col("l2_subcategory"), F.coalesce("pl_line_item", F.lit(""))
    agg = mapped.groupBy(*KEY).agg(
        sum_where(l1 == "Revenue", "signed").alias("revenue"),
        sum_where(line == "Other Operating Income", "signed").alias("other_operating_income"),
        sum_where(l1 == "COGS", "signed").alias("cogs"),
        sum_where((l1 == "OPEX") & (l2 == "Payroll"), "signed").alias("opex_personnel"),
        sum_where((l1 == "OPEX") & (line == "DA"), "signed").alias("opex_depreciation"),
        sum_where((l1 == "OPEX") & (l2 != "Payroll") & (line != "DA"), "signed").alias("opex_other"),
        sum_where(line == "Fin_Income", "signed").alias("financial_income"),
        sum_where(line == "Fin_Expense", "signed").alias("financial_expense"),
        sum_where(line == "Tax", "signed").alias("tax_expense"),
        F.sum("postings").alias("transaction_count"),
    )
    c = F.col
    gp = c("revenue") - c("cogs")
    ebitda = gp + c("other_operating_income") - c("opex_personnel") - c("opex_other")
    frame = agg.withColumns({"gross_profit": gp, "opex_total": c("opex_personnel") + c("opex_depreciation") + c("opex_other"),
                             "ebitda": ebitda, "ebit": ebitda - c("opex_depreciation"),
                             "net_interest_expense": c("financial_expense") - c("financial_income")})
    frame = frame.withColumn("profit_before_tax", c("ebit") - c("net_interest_expense"))
    frame = frame.withColumn("net_profit", c("profit_before_tax") - c("tax_expense"))
    frame = frame.withColumns({f"{n}_margin_ratio": ratio(c(col), c("revenue"), 4, otherwise=0)
                               for n, col in (("gross", "gross_profit"), ("ebitda", "ebitda"), ("ebit", "ebit"), ("net_profit", "net_profit"))})
    totals = budget_totals(by_line).select(
        *KEY, "revenue_budget", "cogs_budget", "opex_budget",
        (c("revenue_budget") - c("cogs_budget") - c("_cash_opex_budget")).alias("ebitda_budget"),
        (c("revenue_budget") - c("cogs_budget") - c("opex_budget")).alias("net_profit_budget"))
    frame = prior_year(frame.join(totals, KEY, "left"), KEY, {"revenue": "revenue_py", "ebitda": "ebitda_py", "net_profit": "net_profit_py"})
    ytd = Window.partitionBy("entity_key", F.floor(c("period_key") / 100)).orderBy("period_key").rowsBetween(Window.unboundedPreceding, 0)
    return frame.withColumns({
        "revenue_variance": c("revenue") - c("revenue_budget"),
        "revenue_variance_ratio": ratio(c("revenue") - c("revenue_budget"), c("revenue_budget"), 4),
        "ebitda_variance": c("ebitda") - c("ebitda_budget"),
        "ebitda_variance_ratio": ratio(c("ebitda") - c("ebitda_budget"), c("ebitda_budget"), 4),
        "revenue_yoy_ratio": ratio(c("revenue") - c("revenue_py"), c("revenue_py"), 4),
        "ebitda_yoy_ratio": ratio(c("ebitda") - c("ebitda_py"), c("ebitda_py"), 4),
        **{f"{x}_ytd": F.sum(x).over(ytd) for x in ("revenue", "ebitda", "net_profit", "revenue_budget", "revenue_py")},
    })


# ---- balance sheet ----------------------------------------------------------------------------------------------
def balance_sheet_nodes(staged: DataFrame, accounts: DataFrame) -> DataFrame:
    taxonomy = accounts.select("account_code", "universal_node", "account_type", "l1_category", "l2_subcategory")
    return (
        staged.join(taxonomy, "account_code")
        .groupBy(*KEY, "universal_node", "account_type", "l1_category", "l2_subcategory")
        .agg(F.sum(signed_balance("closing_balance", "normal_balance")).cast("decimal(28,2)").alias("closing_balance"),
             F.sum(F.col("closing_balance") - F.col("opening_balance")).cast("decimal(28,2)").alias("period_movement"))
    )


def balance_check(nodes: DataFrame, tolerance: float = 1.0) -> DataFrame:
    side = F.col("account_type")
    difference = F.col("total_assets") - F.col("total_liabilities_equity")
    return nodes.groupBy(*KEY).agg(
        sum_where(side == "Asset", "closing_balance").alias("total_assets"),
        sum_where(side.isin("Liability", "Equity"), "closing_balance").alias("total_liabilities_equity"),
    ).withColumns({"balance_difference": difference, "is_balanced": F.abs(difference) < tolerance})


def bs_buckets(nodes: DataFrame) -> DataFrame:
    closing = lambda cond, name: sum_where(cond, "closing_balance").alias(name)
    kind = F.col("account_type")
    return nodes.groupBy(*KEY).agg(
        closing(under("ASSET.CURRENT"), "current_assets"), closing(under("ASSET.CURRENT.CASH"), "cash"),
        closing(under("ASSET.CURRENT.RECEIVABLES"), "trade_receivables"), closing(under("ASSET.CURRENT.INVENTORY"), "inventory"),
        closing(under("ASSET.NONCURRENT"), "noncurrent_assets"), closing(under("LIABILITY.CURRENT"), "current_liabilities"),
        closing(under("LIABILITY.CURRENT.PAYABLES"), "trade_payables"), closing(under("LIABILITY.NONCURRENT"), "noncurrent_liabilities"),
        closing(under_any("LIABILITY.NONCURRENT.DEBT", "LIABILITY.CURRENT.DEBT"), "total_debt"),
        closing(kind == "Equity", "total_equity"), closing(kind == "Asset", "total_assets"),
    )


def balance_sheet_wide(nodes: DataFrame) -> DataFrame:
    """One row per period and entity with the statement lines, totals, working capital, net debt and last year's figures."""
    lines = {
        "intangible_assets": under("ASSET.NONCURRENT.INTANGIBLE"),
        "tangible_assets": under_any("ASSET.NONCURRENT.PPE", "ASSET.NONCURRENT.ACCUMULATED_DEPRECIATION"),
        "financial_investments": under("ASSET.NONCURRENT.FINANCIAL"), "inventory": under("ASSET.CURRENT.INVENTORY"),
        "trade_receivables": under("ASSET.CURRENT.RECEIVABLES.TRADE"),
        "other_receivables": under("ASSET.CURRENT.RECEIVABLES") & ~under("ASSET.CURRENT.RECEIVABLES.TRADE"),
        "securities": under("ASSET.CURRENT.SECURITIES"), "cash_and_equivalents": under("ASSET.CURRENT.CASH"),
        "accrued_income": under("ASSET.CURRENT.PREPAYMENTS"), "share_capital": under("EQUITY.SHARE_CAPITAL"),
        "retained_earnings": under("EQUITY.RETAINED_EARNINGS"), "profit_for_period": under("EQUITY.CURRENT_YEAR_PROFIT"),
        "long_term_debt": under("LIABILITY.NONCURRENT.DEBT"), "short_term_debt": under("LIABILITY.CURRENT.DEBT"),
        "trade_payables": under("LIABILITY.CURRENT.PAYABLES"), "other_current_liabilities": under("LIABILITY.CURRENT.OTHER"),
    }
    c = F.col
    wide = nodes.groupBy(*KEY).agg(*[sum_where(cond, "closing_balance").alias(n) for n, cond in lines.items()]).withColumns({
        "total_fixed_assets": c("intangible_assets") + c("tangible_assets") + c("financial_investments"),
        "total_receivables": c("trade_receivables") + c("other_receivables"),
        "total_current_assets": c("inventory") + c("trade_receivables") + c("other_receivables") + c("securities") + c("cash_and_equivalents"),
        "total_equity": c("share_capital") + c("retained_earnings") + c("profit_for_period"),
        "total_current_liabilities": c("short_term_debt") + c("trade_payables") + c("other_current_liabilities"),
        "net_debt": c("long_term_debt") + c("short_term_debt") - c("cash_and_equivalents"),
    }).withColumns({
        "total_assets": c("total_fixed_assets") + c("total_current_assets") + c("accrued_income"),
        "total_liabilities_equity": c("total_equity") + c("long_term_debt") + c("total_current_liabilities"),
        "net_working_capital": c("total_current_assets") - c("trade_payables") - c("other_current_liabilities"),
    }).withColumn("balance_check", c("total_assets") - c("total_liabilities_equity"))
    return prior_year(wide, KEY, {x: f"{x}_py" for x in ("total_assets", "total_equity", "trade_receivables", "inventory",
                                                         "trade_payables", "cash_and_equivalents")})


# ---- cash flow --------------------------------------------------------------------------------------------------
WORKING_CAPITAL = ["delta_receivables", "delta_inventory", "delta_payables", "delta_other_current_assets", "delta_other_current_liabilities"]
INVESTING = ["capex", "financial_investments"]
FINANCING = ["net_debt_change", "equity_transactions"]
CASH = ["closing_cash", "opening_cash"]


def cashflow_movements(nodes: DataFrame) -> DataFrame:
    """All cash-flow lines in one pass; cash columns are null where the entity has no cash node."""
    m, closing = F.col("period_movement"), F.col("closing_balance")
    current, liab = under("ASSET.CURRENT"), under("LIABILITY.CURRENT")
    cash = under("ASSET.CURRENT.CASH")
    named = under_any("ASSET.CURRENT.CASH", "ASSET.CURRENT.RECEIVABLES", "ASSET.CURRENT.INVENTORY")
    return nodes.groupBy(*KEY).agg(
        (-sum_where(under("ASSET.CURRENT.RECEIVABLES"), m)).alias("delta_receivables"),
        (-sum_where(under("ASSET.CURRENT.INVENTORY"), m)).alias("delta_inventory"),
        sum_where(under("LIABILITY.CURRENT.PAYABLES"), m).alias("delta_payables"),
        (-sum_where(current & ~named, m)).alias("delta_other_current_assets"),
        sum_where(liab & ~under("LIABILITY.CURRENT.PAYABLES"), m).alias("delta_other_current_liabilities"),
        (-sum_where(under_any("ASSET.NONCURRENT.PPE", "ASSET.NONCURRENT.INTANGIBLE"), m)).alias("capex"),
        (-sum_where(under("ASSET.NONCURRENT.FINANCIAL"), m)).alias("financial_investments"),
        sum_where(under("LIABILITY.NONCURRENT.DEBT"), m).alias("net_debt_change"),
        sum_where(under("EQUITY") & ~under("EQUITY.RETAINED_EARNINGS"), m).alias("equity_transactions"),
        F.sum(F.when(cash, closing)).alias("closing_cash"), F.sum(F.when(cash, closing - m)).alias("opening_cash"),
    )


def cashflow_indirect(pl: DataFrame, movements: DataFrame) -> DataFrame:
    c = F.col
    joined = pl.select(*SCOPED, "net_profit", c("depreciation_amortisation").alias("add_back_da")).join(movements, KEY, "left")
    working = c("net_profit") + c("add_back_da")
    for x in WORKING_CAPITAL:
        working = working + c(x)
    return joined.withColumn("operating_cash_flow", working).withColumns({
        "investing_cash_flow": c("capex") + c("financial_investments"),
        "financing_cash_flow": c("net_debt_change") + c("equity_transactions"),
        "free_cash_flow": c("operating_cash_flow") + c("capex"),
    }).withColumn("net_cash_movement", c("operating_cash_flow") + c("investing_cash_flow") + c("financing_cash_flow"))
