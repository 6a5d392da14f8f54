"""Fact packs for commentary."""

from pyspark.sql import DataFrame, functions as F

from ..functions import text as T
from ..functions.periods import period_label
from .statements import KEY

MATERIAL_PCT, ALERT_PCT = 5.0, 10.0


def fact_pack(prof: DataFrame, liq: DataFrame, cash: DataFrame, entities: DataFrame) -> DataFrame:
    """One nested document per entity and month: figures as display text, small changes masked, large ones tagged."""
    E = "consolidation_scope = 'entity'"
    c = F.col
    j = (prof.where(E).drop("consolidation_scope", "total_assets", "total_equity", "net_debt", "total_debt", "cash")
         .join(liq.where(E).select(*KEY, "current_ratio", "dso_days", "dpo_days", "cash_conversion_cycle_days", "net_debt_ebitda", "total_assets",
                                   "total_equity", "net_debt", "equity_ratio_pct"), KEY)
         .join(cash.where(E).select(*KEY, "operating_cash_flow", "free_cash_flow", "cash_and_equivalents"), KEY)
         .join(entities.select("entity_key", "entity_code"), "entity_key"))
    huf = lambda x: T.shown(x, T.fmt_millions(x)).alias(x)
    pct = lambda x: T.shown(x, T.fmt_percent(x)).alias(x)
    masked = lambda x, name: F.when(T.is_material(x, MATERIAL_PCT), T.fmt_percent(x)).otherwise("within materiality").alias(name)
    alert = lambda x, label: F.when(F.coalesce(F.abs(x) > ALERT_PCT, F.lit(False)), F.struct(
        F.lit(label).alias("kpi"), T.fmt_percent(x).alias("value"), F.lit("[ALERT]").alias("alert_tag"),
        F.when(c(x) > 0, "above target").otherwise("below target").alias("direction")))
    alerts = F.filter(F.array(alert("revenue_variance_pct", "Revenue vs Budget"), alert("revenue_yoy_pct", "Revenue vs Prior Year")), lambda a: a.isNotNull())
    return j.select(
        *KEY,
        F.struct(c("entity_code"), period_label("period_key").alias("period"), c("period_key"), F.lit("HUF").alias("reporting_currency")).alias("report_metadata"),
        F.struct(huf("revenue"), huf("revenue_budget"), masked("revenue_variance_pct", "revenue_vs_budget_pct"), masked("revenue_yoy_pct", "revenue_vs_py_pct"),
                 pct("gross_margin_pct"), huf("ebitda"), pct("ebitda_margin_pct"), huf("net_profit"), pct("net_profit_margin_pct")).alias("pl_summary"),
        F.struct(huf("total_assets"), huf("total_equity"), huf("net_debt"), pct("equity_ratio_pct"),
                 T.shown("net_debt_ebitda", T.fmt_multiple("net_debt_ebitda")).alias("net_debt_to_ebitda")).alias("balance_sheet_highlights"),
        F.struct(T.shown("current_ratio", T.fmt_multiple("current_ratio")).alias("current_ratio"), T.shown("dso_days", T.fmt_days("dso_days")).alias("dso_days"),
                 T.shown("dpo_days", T.fmt_days("dpo_days")).alias("dpo_days"),
                 T.shown("cash_conversion_cycle_days", T.fmt_days("cash_conversion_cycle_days")).alias("cash_conversion_cycle_days")).alias("liquidity_highlights"),
        F.struct(huf("operating_cash_flow"), huf("free_cash_flow"), huf("cash_and_equivalents")).alias("cash_flow"),
        alerts.alias("alerts"))


def as_json(packs: DataFrame) -> DataFrame:
    body = [c for c in packs.columns if c not in KEY]
    return packs.select(*KEY, F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("fact_pack"))
