"""Named measures over the books, evaluated for any grouping.

A measure frame stacks the movements, balances, cash-flow and budget rows as (entity, period, source, category columns, amount), so
one grouped pass serves every base measure; derived measures are expressions over them and time shifts are windows over the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.money import dbl, ratio
from ..functions.periods import month_index
from ..plans import constants as K




def measure_frame(mapped: DataFrame, nodes: DataFrame, budget_lines: DataFrame) -> DataFrame:
    """Rows: source gl / bs / cf / budget, with the P&L line, balance-sheet category or cash-flow category they belong to."""
    c = F.col
    blank = F.lit(None).cast("string")
    line = F.when(c("pl_line_item") == "Fin_Income", "Financial Income").when(c("pl_line_item") == "Fin_Expense", "Financial Expense").when(
        c("pl_line_item") == "Tax", "Tax Expense").otherwise(c("pl_line_item"))
    row = lambda source, cat, sub, amount: [*["entity_key", "period_key"], F.lit(source).alias("source"), cat.alias("category"), sub.alias("subcategory"),
                                            amount.cast("decimal(28,2)").alias("amount")]
    gl = mapped.where("pl_line_item IS NOT NULL").select(*row("gl", line, c("l2_subcategory"), c("signed")))
    node = c("universal_node")
    category = (F.when(node.startswith("ASSET.CURRENT"), "Current Assets").when(node.startswith("ASSET."), "Non-Current Assets")
                .when(node.startswith("LIABILITY.CURRENT"), "Current Liabilities").when(node.startswith("LIABILITY."), "Non-Current Liabilities").otherwise("Equity"))
    sub = F.when(node.startswith("ASSET.CURRENT.RECEIVABLES.TRADE"), "Trade Receivables").when(node.startswith("LIABILITY.CURRENT.PAYABLES.TRADE"), "Trade Payables")
    bs = nodes.select(*row("bs", category, sub, c("closing_balance")))
    cf_category = (F.when(node.startswith("ASSET.CURRENT.CASH"), blank).when(node.startswith("ASSET.NONCURRENT"), "Investing")
                   .when(node.startswith("LIABILITY.NONCURRENT") | node.startswith("LIABILITY.CURRENT.DEBT"), "Financing").otherwise("Operating"))
    capex = F.when(node.startswith("ASSET.NONCURRENT.PPE"), "Capex")
    cf = nodes.select(*row("cf", cf_category, capex, -c("period_movement"))).where("category IS NOT NULL")
    kind = F.when(c("l1_category") == "Revenue", "Revenue").when(c("l1_category") == "COGS", "COGS").otherwise(c("pl_line_item"))
    budget = budget_lines.select(*row("budget", kind, blank, c("budget_amount")))
    return gl.unionByName(bs).unionByName(cf).unionByName(budget)


def _base(source: str, category: str, sub: str | None = None) -> Column:
    cond = (F.col("source") == source) & (F.col("category") == category)
    if sub:
        cond = cond & (F.col("subcategory") == sub)
    return F.coalesce(F.sum(F.when(cond, F.col("amount"))), F.lit(0).cast("decimal(28,2)"))


BASE = {
    "revenue": ("gl", "Revenue"), "cogs": ("gl", "COGS"), "personnel_expense": ("gl", "Personnel"), "other_opex": ("gl", "Other OpEx"),
    "other_operating_income": ("gl", "Other Operating Income"), "financial_income": ("gl", "Financial Income"),
    "financial_expense": ("gl", "Financial Expense"), "tax_expense": ("gl", "Tax Expense"),
    "total_current_assets": ("bs", "Current Assets"), "total_non_current_assets": ("bs", "Non-Current Assets"),
    "total_current_liabilities": ("bs", "Current Liabilities"), "total_non_current_liabilities": ("bs", "Non-Current Liabilities"),
    "total_equity": ("bs", "Equity"), "receivables": ("bs", "Current Assets", "Trade Receivables"),
    "payables": ("bs", "Current Liabilities", "Trade Payables"),
    "operating_cash_flow": ("cf", "Operating"), "investing_cash_flow": ("cf", "Investing"), "financing_cash_flow": ("cf", "Financing"),
    "capex": ("cf", "Investing", "Capex"),
}
BUDGET = {"revenue_budget": ["Revenue"], "cash_cost_budget": ["COGS", "Personnel", "Other OpEx"]}


def _rag(share: Column) -> Column:
    return F.when(share.isNull(), "GREY").when(share >= 0, "GREEN").when(share >= -0.05, "AMBER").otherwise("RED")


def _derived() -> dict[str, Column]:
    c = F.col
    gp = c("revenue") - c("cogs")
    ebitda = gp + c("other_operating_income") - c("personnel_expense") - c("other_opex")
    net = ebitda + c("financial_income") - c("financial_expense") - c("tax_expense")
    ebitda_budget = c("revenue_budget") - c("cash_cost_budget")
    liabilities = c("total_current_liabilities") + c("total_non_current_liabilities")
    variance = c("revenue") - c("revenue_budget")
    return {
        "gross_profit": gp, "gross_margin_pct": ratio(gp, c("revenue"), 6), "ebitda": ebitda, "ebitda_margin_pct": ratio(ebitda, c("revenue"), 6),
        "net_profit": net, "total_assets": c("total_current_assets") + c("total_non_current_assets"), "total_liabilities": liabilities,
        "debt_to_equity": ratio(liabilities, c("total_equity"), 6), "free_cash_flow": c("operating_cash_flow") + c("capex"),
        "working_capital": c("total_current_assets") - c("total_current_liabilities"),
        "current_ratio": ratio(c("total_current_assets"), c("total_current_liabilities"), 6),
        "revenue_variance": variance, "revenue_variance_pct": ratio(variance, c("revenue_budget"), 6),
        "ebitda_variance": ebitda - ebitda_budget, "revenue_rag": _rag(ratio(variance, c("revenue_budget"), 6)),
        "ebitda_rag": _rag(ratio(ebitda - ebitda_budget, F.abs(ebitda_budget), 6)),
    }


TIME = ["days_sales_outstanding", "days_payable_outstanding", "revenue_ytd", "ebitda_ytd", "net_profit_ytd", "revenue_py", "revenue_yoy_pct"]
NAMES = [*BASE, "revenue_budget", "gross_profit", "gross_margin_pct", "ebitda", "ebitda_margin_pct", "net_profit", "total_assets", "total_liabilities",
         "debt_to_equity", "free_cash_flow", "working_capital", "current_ratio", "revenue_variance", "revenue_variance_pct", "ebitda_variance",
         "revenue_rag", "ebitda_rag", *TIME]


def evaluate(frame: DataFrame, names: list[str], group_by: list[str]) -> DataFrame:
    """Named measures per group. Time measures need `period_key` among the grouping columns."""
    unknown = set(names) - set(NAMES)
    if unknown:
        raise ValueError(f"unknown measures: {sorted(unknown)}")
    sums = [_base(*spec).alias(n) for n, spec in BASE.items()]
    for n, cats in BUDGET.items():
        hit = F.when(F.coalesce(F.col("category").isin(*cats), F.lit(False)), F.col("amount")).otherwise(F.lit(0).cast("decimal(28,2)"))
        sums.append(F.sum(F.when(F.col("source") == "budget", hit)).alias(n))  # blank only where nothing is budgeted at all
    out = frame.groupBy(*group_by).agg(*sums).withColumns(_derived())
    if set(names) & set(TIME):
        out = _with_time(out, [g for g in group_by if g != "period_key"])
    return out.select(*group_by, *names)


def _with_time(df: DataFrame, keys: list[str]) -> DataFrame:
    c = F.col
    mi = month_index("period_key")
    quarter = Window.partitionBy(*keys).orderBy(mi).rangeBetween(-2, 0)
    ytd = Window.partitionBy(*keys, F.floor(c("period_key") / 100)).orderBy("period_key").rowsBetween(Window.unboundedPreceding, 0)
    year_ago = Window.partitionBy(*keys).orderBy(mi).rangeBetween(-12, -12)
    return df.withColumns({
        "days_sales_outstanding": ratio(c("receivables"), dbl(F.sum("revenue").over(quarter)) / 90, 4),
        "days_payable_outstanding": ratio(c("payables"), dbl(F.sum("cogs").over(quarter)) / 90, 4),
        **{f"{x}_ytd": F.sum(x).over(ytd) for x in ("revenue", "ebitda", "net_profit")},
        "revenue_py": F.sum("revenue").over(year_ago),
    }).withColumn("revenue_yoy_pct", ratio(c("revenue") - c("revenue_py"), F.abs(c("revenue_py")), 6))


def pl_bridge(components: DataFrame) -> DataFrame:
    """Waterfall steps from revenue to net profit with the running start and end of each bar."""
    c = F.col
    amounts = [c("revenue"), c("other_operating_income"), c("cogs"), c("gross_profit"), c("opex_personnel"), c("opex_other"), c("ebitda"),
               c("opex_depreciation"), c("financial_income") - c("financial_expense"), c("tax_expense"), c("net_profit")]
    steps = F.array(*[F.struct(F.lit(n).alias("step"), F.lit(label).alias("label"), F.lit(kind).alias("kind"), a.cast("decimal(28,2)").alias("amount"))
                      for (n, label, kind), a in zip(K.BRIDGE_STEPS, amounts)])
    rows = components.select("period_key", "entity_key", F.explode(steps).alias("s")).select("period_key", "entity_key", "s.*")
    rows = rows.withColumn("delta", F.when(c("kind") == "subtract", -c("amount")).when(c("kind").isin("subtotal", "end"), F.lit(0)).otherwise(c("amount")).cast("decimal(28,2)"))
    run = F.sum("delta").over(Window.partitionBy("period_key", "entity_key").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumns({
        "bar_start": F.when(c("kind").isin("start", "subtotal", "end"), F.lit(0)).otherwise(run - c("delta")).cast("decimal(38,2)"),
        "bar_end": F.when(c("kind").isin("subtotal", "end"), c("amount")).otherwise(run).cast("decimal(38,2)"),
    })
