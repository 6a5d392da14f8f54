"""Financial ratios, project results and window building blocks."""

from pyspark.sql import functions as F

from ..functions.money import rnd
from ..operators import kpi, project as prj, windows as W
from ..operators.statements import KEY, SCOPED
from .oracle_tables import dec, ratio as sql_ratio
from .registry import query

E = "consolidation_scope = 'entity'"


def pick(key, table, frame, cols, scoped=True):
    keys = "period_key, entity_key" + (", consolidation_scope" if scoped else "")
    query(key, f"select {keys}, {', '.join(cols)} from {table}")(
        lambda b: frame(b).select(*(SCOPED if scoped else KEY), *cols))


prof, liq, cash = (lambda b: b.profitability), (lambda b: b.liquidity), (lambda b: b.cash_kpis)
for _key, _cols in {
    "kpi_gross_margin": ["revenue", "gross_profit", "gross_margin_pct"], "kpi_ebitda": ["ebitda"], "kpi_ebitda_margin": ["ebitda", "ebitda_margin_pct"],
    "kpi_net_margin": ["net_profit", "net_profit_margin_pct"], "kpi_roa": ["net_profit", "total_assets", "roa_pct"],
    "kpi_roe": ["net_profit", "total_equity", "roe_pct"], "kpi_roic": ["invested_capital", "roic_pct"],
    "kpi_revenue_variance": ["revenue", "revenue_budget", "revenue_variance", "revenue_variance_pct"],
    "kpi_revenue_yoy": ["revenue", "revenue_py", "revenue_yoy", "revenue_yoy_pct"],
}.items():
    pick(_key, "t_prof", prof, _cols)
query("kpi_profitability", "select * from t_prof")(prof)
pick("kpi_ebitda_ddl", "t_comp", lambda b: b.components, ["ebitda", "ebitda_margin_ratio"], scoped=False)
RET = f"""with x as (select c.period_key, c.entity_key, net_profit, cast(sum(total_assets) over w as double) / count(total_assets) over w ma, cast(sum(total_equity) over w as double) / count(total_equity) over w me
 from t_comp c left join t_wide b on b.period_key = c.period_key and b.entity_key = c.entity_key window w as (partition by c.entity_key order by c.period_key rows between 1 preceding and current row))"""
query("kpi_roa_window", RET + f" select period_key, entity_key, {sql_ratio('net_profit', 'ma', 6)} return_on_assets from x")(
    lambda b: kpi.returns_moving_average(b.components, b.wide).select(*KEY, "return_on_assets"))
query("kpi_roe_window", RET + f" select period_key, entity_key, {sql_ratio('net_profit', 'me', 6)} return_on_equity from x")(
    lambda b: kpi.returns_moving_average(b.components, b.wide).select(*KEY, "return_on_equity"))
query("kpi_staff_cost_ratio", f"select period_key, entity_key, {sql_ratio('opex_personnel', 'revenue', 4, 100)} staff_cost_ratio_pct from t_comp")(
    lambda b: kpi.staff_cost_ratio(b.components))
query("kpi_rule_of_40", f"""select c.period_key, c.entity_key, case when revenue_yoy_ratio is not null and revenue <> 0 then
 round((revenue_yoy_ratio * 100 + cast(coalesce(free_cash_flow, 0) as double) / cast(revenue as double) * 100) * (1 + 1e-12), 4) end rule_of_40
 from t_comp c left join t_cf f on f.period_key = c.period_key and f.entity_key = c.entity_key and {E}""")(
    lambda b: kpi.rule_of_40(b.components, b.cashflow))
SEAS = f"""select period_key, entity_key, revenue, {sql_ratio('revenue', '(cast(sum(revenue) over w as double) / count(revenue) over w)', 6)} IDX from t_comp
 window w as (partition by entity_key, period_key % 100 order by period_key rows between 4 preceding and current row)"""
query("kpi_seasonal_index", SEAS.replace("IDX", "seasonal_revenue_index"))(
    lambda b: b.components.select(*KEY, "revenue", W.seasonal_index("revenue").alias("seasonal_revenue_index")))
query("seasonal_index", SEAS.replace("t_comp", f"t_act where {E}").replace("IDX", "seasonal_index"))(
    lambda b: b.pl.where(E).select(*KEY, "revenue", W.seasonal_index("revenue").alias("seasonal_index")))

query("kpi_bs_buckets", "select * from t_buckets")(lambda b: b.buckets)
for _key, _cols in {
    "kpi_current_ratio": ["current_assets", "current_liabilities", "current_ratio"], "kpi_quick_ratio": ["inventory", "quick_ratio"],
    "kpi_dso_monthly30": ["dso_days"], "kpi_dpo_monthly30": ["dpo_days"], "kpi_dio_monthly30": ["dio_days"],
    "kpi_ccc": ["cash_conversion_cycle_days"], "kpi_net_debt_ebitda": ["net_debt", "ebitda_ltm", "net_debt_ebitda"],
    "kpi_interest_coverage": ["interest_coverage"], "kpi_equity_ratio": ["equity_ratio_pct"], "kpi_gearing": ["gearing_ratio_pct"],
}.items():
    pick(_key, "t_liq", liq, _cols)
query("kpi_liquidity", "select * from t_liq")(liq)
annual = lambda b: kpi.liquidity_annualised(b.wide, b.components, b.cashflow)
for _key, _cols in {
    "kpi_dso_annualised": ["dso_days"], "kpi_dpo_annualised": ["dpo_days"], "kpi_dio_annualised": ["dio_days"],
    "kpi_net_debt_ebitda_ytd": ["net_debt_to_ebitda"], "kpi_dscr": ["debt_service_coverage"], "kpi_inventory_turnover": ["inventory_turnover"],
    "kpi_gmroi": ["gmroi"], "kpi_liquidity_annualised": ["dso_days", "dpo_days", "dio_days", "cash_conversion_cycle", "interest_coverage",
                                                         "equity_ratio_pct", "gearing_ratio"],
}.items():
    pick(_key, "t_liqa", annual, _cols, scoped=False)
for _key, _col in (("kpi_dso_trailing3m", "dso_days"), ("kpi_dpo_trailing3m", "dpo_days")):
    pick(_key, "t_dso3", lambda b: kpi.days_trailing_quarter(b.buckets, b.pl), [_col], scoped=False)

for _key, _cols in {
    "kpi_ocf_margin": ["operating_cash_flow", "ocf_margin_pct"], "kpi_capex_intensity": ["capex", "capex_intensity_pct"],
    "kpi_cf_conversion": ["cf_conversion_pct"], "kpi_burn_rate": ["monthly_burn_rate"], "kpi_cash_runway": ["cash_runway_months"],
    "kpi_burn_rate_fcf": ["cash_burn_rate_fcf"], "kpi_reinvestment": ["reinvestment_rate_pct"], "kpi_fcf_margin_ltm": ["fcf_ltm", "fcf_margin_ltm_pct"],
    "kpi_fcf_margin": ["free_cash_flow", "fcf_margin_pct"], "kpi_cash_movement": ["cash_and_equivalents", "prior_cash_balance", "cash_movement_period"],
}.items():
    pick(_key, "t_ck", cash, _cols)
query("kpi_cashflow", "select * from t_ck")(cash)

# ---- projects -------------------------------------------------------------------------------------------------
actuals = lambda b: b.stored("project_actuals", lambda: prj.project_actuals(b.project_balance, b.accounts))
PCOLS = ["project_revenue", "project_cogs", "project_labour_cost", "project_nonlabour_cost", "project_total_cost", "project_revenue_eur", "project_total_cost_eur"]
query("project_actuals", f"select period_key, entity_key, project, {', '.join(PCOLS)} from t_proj0")(
    lambda b: actuals(b).select(*prj.GRAIN, *PCOLS))
query("project_ytd", "select period_key, entity_key, project, fiscal_year, ytd_revenue, ytd_total_cost, ytd_labour_cost from t_proj")(
    lambda b: prj.project_ytd(actuals(b)).select(*prj.GRAIN, "fiscal_year", "ytd_revenue", "ytd_total_cost", "ytd_labour_cost"))
query("project_overrun", "select period_key, entity_key, project, ytd_total_cost, project_budget, ytd_cost_vs_budget, ytd_cost_overrun_pct, is_cost_overrun from t_proj")(
    lambda b: prj.project_overrun(prj.project_ytd(actuals(b)), prj.budgets_from_last_year(actuals(b))).select(
        *prj.GRAIN, "ytd_total_cost", "project_budget", "ytd_cost_vs_budget", "ytd_cost_overrun_pct", "is_cost_overrun"))
query("project_margin", f"""select period_key, entity_key, project, project_revenue, project_cogs project_direct_cost, project_expense project_total_cost,
 project_revenue - project_cogs project_gross_profit, project_revenue - project_expense project_net_contribution,
 {sql_ratio('(project_revenue - project_cogs)', 'project_revenue', 4, 100)} project_gross_margin_pct, {sql_ratio('(project_revenue - project_expense)', 'project_revenue', 4, 100)} project_net_margin_pct,
 cast(postings as bigint) transaction_count from t_proj0""")(lambda b: prj.project_margin(actuals(b)))
query("kpi_project", "select * from t_proj")(lambda b: prj.kpi_project(actuals(b), prj.budgets_from_last_year(actuals(b))))

# ---- windows --------------------------------------------------------------------------------------------------
entity_cf = lambda b: b.cashflow.where(E).join(b.pl.where(E).select(*KEY, "ebitda"), KEY)
LTM = f"""select c.period_key, c.entity_key, {dec('sum(ebitda) over w')} ebitda_ltm, {dec('sum(operating_cash_flow) over w')} ocf_ltm, {dec('sum(free_cash_flow) over w')} fcf_ltm, {dec('sum(capex) over w')} capex_ltm
 from t_cf c join t_pl p on p.period_key = c.period_key and p.entity_key = c.entity_key and p.consolidation_scope = c.consolidation_scope where c.consolidation_scope = 'entity'
 window w as (partition by c.entity_key order by FRAME)"""
FLOWS = {"ebitda": "ebitda_ltm", "operating_cash_flow": "ocf_ltm", "free_cash_flow": "fcf_ltm", "capex": "capex_ltm"}
query("ltm_sums", LTM.replace("FRAME", "c.period_key rows between 11 preceding and current row"))(
    lambda b: entity_cf(b).select(*KEY, *[W.trailing_rows(a).alias(n) for a, n in FLOWS.items()]))
query("ltm_sums_calendar", LTM.replace("FRAME", "(c.period_key // 100) * 12 + c.period_key % 100 range between 11 preceding and current row"))(
    lambda b: entity_cf(b).select(*KEY, *[W.trailing_months(a).alias(n) for a, n in FLOWS.items()]))
query("lag_balances", "select period_key, entity_key, total_assets, total_equity, cash, prior_total_assets, prior_total_equity, prior_cash from t_bslag")(
    lambda b: b.buckets.select(*KEY, "total_assets", "total_equity", "cash", W.previous("total_assets").alias("prior_total_assets"),
                               W.previous("total_equity").alias("prior_total_equity"), W.previous("cash").alias("prior_cash")))
query("average_balance_2p", """select period_key, entity_key, round(cast(sum(total_assets) over w as double) / count(total_assets) over w * (1 + 1e-12), 4) average_assets,
 round(cast(sum(total_equity) over w as double) / count(total_equity) over w * (1 + 1e-12), 4) average_equity from t_buckets window w as (partition by entity_key order by period_key rows between 1 preceding and current row)""")(
    lambda b: b.buckets.select(*KEY, rnd(W.moving_average("total_assets"), 4).alias("average_assets"), rnd(W.moving_average("total_equity"), 4).alias("average_equity")))
query("ytd_cumulative", f"""select period_key, entity_key, {dec('sum(revenue) over w')} revenue_ytd, {dec('sum(net_profit) over w')} net_profit_ytd from t_pl where {E}
 window w as (partition by entity_key, period_key // 100 order by period_key rows unbounded preceding)""")(
    lambda b: b.pl.where(E).select(*KEY, W.year_to_date("revenue").alias("revenue_ytd"), W.year_to_date("net_profit").alias("net_profit_ytd")))
query("balance_rollforward", f"""select period_key, entity_key, account_code, {dec('movement')} movement, {dec('sum(movement) over w - movement')} opening, {dec('sum(movement) over w')} closing
 from (select period_key, entity_key, account_code, sum(net) movement from tb group by all) window w as (partition by entity_key, account_code order by period_key rows unbounded preceding)""")(
    lambda b: b.trial_balance.groupBy("period_key", "entity_key", "account_code").agg(F.sum("net").cast("decimal(28,2)").alias("movement"))
    .withColumn("closing", W.running_total("movement", ("entity_key", "account_code")))
    .withColumn("opening", F.col("closing") - F.col("movement")))
BRIDGE = [("Revenue", 1, "start"), ("Other Operating Income", 2, "add"), ("COGS", 3, "subtract"), ("Gross Profit", 4, "subtotal"), ("Personnel", 5, "subtract"),
          ("Other OpEx", 6, "subtract"), ("EBITDA", 7, "subtotal"), ("Depreciation", 8, "subtract"), ("Financial Items", 9, "add"), ("Tax", 10, "subtract"), ("Net Profit", 11, "end")]
BRIDGE_SQL = """select *, cast(case when kind in ('start', 'subtotal', 'end') then 0 else sum(delta) over w - delta end as decimal(38,2)) bar_start,
 cast(case when kind in ('subtotal', 'end') then amount else sum(delta) over w end as decimal(38,2)) bar_end from (
 select period_key, entity_key, step, label, kind, cast(amount as decimal(38,2)) amount, cast(case kind when 'subtract' then -amount when 'subtotal' then 0 when 'end' then 0 else amount end as decimal(38,2)) delta from (
 """ + " union all ".join(f"select period_key, entity_key, {n} step, '{l}' as label, '{k}' kind, {c} amount from t_comp" for (l, n, k), c in zip(
    BRIDGE, ["revenue", "other_operating_income", "cogs", "gross_profit", "opex_personnel", "opex_other", "ebitda", "opex_depreciation",
             "financial_income - financial_expense", "tax_expense", "net_profit"])) + ")) window w as (partition by period_key, entity_key order by step rows unbounded preceding)"


def bridge(b):
    from ..operators.measures import pl_bridge
    return pl_bridge(b.components)


query("bridge_running_total", BRIDGE_SQL)(bridge)
query("m_pl_bridge", f"select period_key, step, label, kind, {dec('sum(amount)')} amount, {dec('sum(delta)')} delta, {dec('sum(bar_start)')} bar_start, {dec('sum(bar_end)')} bar_end from ({BRIDGE_SQL}) group by all")(
    lambda b: bridge(b).groupBy("period_key", "step", "label", "kind").agg(*[F.sum(c).alias(c) for c in ("amount", "delta", "bar_start", "bar_end")]))
