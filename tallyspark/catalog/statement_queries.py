"""Statements: profit and loss, balance sheet, cash flow, variance and consolidation."""

from pyspark.sql import functions as F

from ..operators import consolidation as con, statements as st, variance as var
from ..plans import constants as K
from .oracle_tables import dec, ratio as sql_ratio
from .registry import query

KEY = st.KEY
ACT = "period_key, entity_key, consolidation_scope, revenue, cogs, opex_total, depreciation_amortisation, financial_income, financial_expense, tax_expense, revenue_eur"

query("trial_balance", "select * from tb")(lambda b: b.movements())
query("cost_balance", """select period_key, account_code, cost_centre, project, count(*) n, sum(debit) debit, sum(credit) credit, sum(net_eur) net_eur, cast(sum(postings) as bigint) postings
 from tbx group by all""")(
    lambda b: b.movements(["cost_centre", "project"]).groupBy("period_key", "account_code", "cost_centre", "project").agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("debit", "credit", "net_eur", "postings")]))
query("pl_actuals_entity", f"select {ACT} from t_act where consolidation_scope = 'entity'")(
    lambda b: st.pl_actuals(b.mapped, ["entity"]))
query("pl_actuals_group", f"select {ACT} from t_act where consolidation_scope = 'group'")(
    lambda b: st.pl_actuals(b.mapped, ["group"]))
query("union_scopes", "select consolidation_scope, count(*) n, sum(revenue) revenue from t_act group by 1")(
    lambda b: st.pl_actuals(b.mapped, ["entity"]).unionByName(st.pl_actuals(b.mapped, ["group"])).groupBy("consolidation_scope")
    .agg(F.count("*").alias("n"), F.sum("revenue").alias("revenue")))
query("pl_monthly", "select * from t_pl")(lambda b: b.build_pl())
query("pl_monthly_ddl", "select * from t_comp")(lambda b: b.build_components())
query("budget_by_line", "select * from t_bline")(lambda b: b.budget_lines)
query("balance_sheet_nodes", "select * from bs_nodes")(lambda b: b.build_nodes())

CHECK = """select period_key, entity_key, cast(sum(case when account_type = 'Asset' then closing_balance else 0 end) as decimal(38,2)) total_assets,
 cast(sum(case when account_type <> 'Asset' then closing_balance else 0 end) as decimal(38,2)) total_liabilities_equity from bs_nodes group by all"""
query("balance_check", f"""with c as ({CHECK}) select n.*, c.total_assets, c.total_liabilities_equity, total_assets - total_liabilities_equity balance_difference,
 abs(total_assets - total_liabilities_equity) < 1 is_balanced from bs_nodes n join c on n.period_key = c.period_key and n.entity_key = c.entity_key""")(
    lambda b: b.nodes.join(st.balance_check(b.nodes), KEY))
query("balance_sheet_wide", "select * from t_wide")(lambda b: b.wide)
query("bs_prior_year_join", """select period_key, entity_key, total_assets, total_assets_py, total_equity, total_equity_py, trade_receivables, trade_receivables_py,
 inventory, inventory_py, trade_payables, trade_payables_py, cash_and_equivalents, cash_and_equivalents_py from t_wide""")(
    lambda b: b.wide.select(*KEY, *[x for n in ("total_assets", "total_equity", "trade_receivables", "inventory", "trade_payables",
                                                "cash_and_equivalents") for x in (n, n + "_py")]))
for _key, _cols in (("cashflow_working_capital", st.WORKING_CAPITAL), ("cashflow_investing", st.INVESTING),
                    ("cashflow_financing", st.FINANCING)):
    query(_key, f"select period_key, entity_key, {', '.join(_cols)} from t_cfm")(
        lambda b, cols=tuple(_cols): st.cashflow_movements(b.nodes).select(*KEY, *cols))
query("cashflow_cash_balance", "select period_key, entity_key, closing_cash, opening_cash from t_cfm where closing_cash is not null")(
    lambda b: st.cashflow_movements(b.nodes).where("closing_cash IS NOT NULL").select(*KEY, *st.CASH))
query("cashflow_indirect", "select * from t_cf")(lambda b: b.build_cashflow())
query("cashflow_reconcile", """select f.period_key, f.entity_key, closing_cash, cash_and_equivalents, closing_cash - cash_and_equivalents difference,
 net_cash_movement - (closing_cash - opening_cash) unexplained_movement from t_cf f join t_wide w on f.period_key = w.period_key and f.entity_key = w.entity_key
 where consolidation_scope = 'entity'""")(
    lambda b: b.cashflow.where("consolidation_scope = 'entity'").join(b.wide.select(*KEY, "cash_and_equivalents"), KEY).select(
        *KEY, "closing_cash", "cash_and_equivalents", (F.col("closing_cash") - F.col("cash_and_equivalents")).alias("difference"),
        (F.col("net_cash_movement") - (F.col("closing_cash") - F.col("opening_cash"))).alias("unexplained_movement")))

# ---- prior year and budget joins ------------------------------------------------------------------------------
query("prior_year_join", """select a.period_key, a.entity_key, a.consolidation_scope, a.revenue, y.revenue revenue_py from t_act a
 left join t_act y on a.entity_key = y.entity_key and a.consolidation_scope = y.consolidation_scope and a.period_key = y.period_key + 100""")(
    lambda b: st.prior_year(st.pl_actuals(b.mapped).select(*st.SCOPED, "revenue"), st.SCOPED, {"revenue": "revenue_py"}))
query("budget_join", """select a.period_key, a.entity_key, a.revenue, a.cogs, b.revenue_budget, b.cogs_budget from t_act a
 left join t_btot b on a.period_key = b.period_key and a.entity_key = b.entity_key where consolidation_scope = 'entity'""")(
    lambda b: st.pl_actuals(b.mapped, ["entity"]).select(*KEY, "revenue", "cogs").join(
        st.budget_totals(b.budget_lines).select(*KEY, "revenue_budget", "cogs_budget"), KEY, "left"))

# ---- variance by cost centre ----------------------------------------------------------------------------------
VAR_CTE = """with act as (select x.period_key, x.entity_key, case when cost_centre <> 'PROMO' then cost_centre end cost_centre, pl_line_item,
   cast(sum(case when account_type = 'Revenue' then -net else net end) as decimal(38,2)) actual_amount
   from tbx x join coa c on x.account_code = c.account_code where pl_line_item is not null group by all),
 v as (select a.*, cast(b.actual_amount * 1.05::decimal(4,2) as decimal(38,2)) budget_amount, b.actual_amount prior_year_amount from act a left join act b on b.period_key + 100 = a.period_key
   and b.entity_key = a.entity_key and b.pl_line_item = a.pl_line_item and b.cost_centre is not distinct from a.cost_centre)"""
query("variance_analysis", VAR_CTE + f""" select period_key, entity_key, cost_centre, pl_line_item, actual_amount, budget_amount, prior_year_amount, actual_amount - budget_amount variance_amount,
 {sql_ratio('(actual_amount - budget_amount)', 'abs(budget_amount)', 4)} variance_ratio, coalesce(abs(actual_amount) > abs(budget_amount), false) is_over_budget,
 coalesce(abs({sql_ratio('(actual_amount - budget_amount)', 'abs(budget_amount)', 4)}) > 0.1, false) alert_threshold_breached,
 actual_amount - prior_year_amount yoy_variance_amount, {sql_ratio('(actual_amount - prior_year_amount)', 'abs(prior_year_amount)', 4)} yoy_variance_ratio,
 cast(sum(actual_amount) over w as decimal(38,2)) actual_ytd, cast(sum(budget_amount) over w as decimal(38,2)) budget_ytd, cast(sum(prior_year_amount) over w as decimal(38,2)) prior_year_ytd
 from v window w as (partition by entity_key, cost_centre, pl_line_item, period_key // 100 order by period_key rows unbounded preceding)""")(
    lambda b: var.variance_analysis(var.line_actuals(b.cost_balance, b.accounts, no_centre="PROMO")))

# ---- coverage, statutory lines, opening balances --------------------------------------------------------------
query("statutory_lines", """select period_key, entity_key, case when account_type in ('Revenue', 'Expense') then 'PL.' || l1_category else 'BS.' || split_part(universal_node, '.', 1) || '.' || split_part(universal_node, '.', 2) end statutory_line,
 cast(sum(net) as decimal(38,2)) total from tbm where not is_ic_account group by all""")(
    lambda b: con.statutory_lines(b.mapped))
query("opening_balance_split", """with x as (select entity_key, account_code, period_key, net, false is_opening from tb union all
  select entity_key, account_code, 200101, closing_balance, true from bs_up where period_year = 2000 and period_month = 12)
 select entity_key, account_code, cast(sum(case when is_opening then 0 else net end) as decimal(38,2)) movement, cast(sum(net) as decimal(38,2)) closing
 from x where period_key // 100 = 2001 group by all""")(
    lambda b: con.opening_balance_split(b.trial_balance, b.balance_upload, 2001))

# ---- consolidation --------------------------------------------------------------------------------------------
query("entity_subtotals", f"""select case when grouping(consolidation_group) = 1 then 'ALL' else consolidation_group end consolidation_group,
 case when grouping(entity_code) = 1 then 'TOTAL' else entity_code end entity_code, cast(grouping(consolidation_group) * 2 + grouping(entity_code) as bigint) level,
 {dec('sum(revenue)')} revenue, {dec('sum(net_profit)')} net_profit from t_pl p join ents e on p.entity_key = e.entity_key where consolidation_scope = 'entity'
 group by rollup (e.consolidation_group, e.entity_code)""")(
    lambda b: con.entity_subtotals(b.pl.where("consolidation_scope = 'entity'"), b.entities))
ELIM = """with sides as (select *, seller_key e, seller_account a, buyer_key c, case elimination_type when 'REVENUE_EXPENSE' then 'Revenue' else 'Receivable' end pl_line_item,
  case elimination_type when 'REVENUE_EXPENSE' then -1 else 1 end sgn from reg where is_active union all
  select *, buyer_key, buyer_account, seller_key, case elimination_type when 'REVENUE_EXPENSE' then 'COGS' else 'Payable' end, case elimination_type when 'REVENUE_EXPENSE' then 1 else -1 end from reg where is_active),
 elim as (select period_key, pair_id, seller_key, buyer_key, transaction_type, elimination_type, pl_line_item, cast(sum(net * sgn) as decimal(38,2)) eliminated_amount, count(*) postings
  from gl g join sides on e = g.entity_key and a = g.account_code and c = g.counterparty_key group by all)"""
query("ic_eliminations", ELIM + " select * from elim")(lambda b: con.ic_eliminations(b.ledger(accounts=K.IC_ACCOUNTS), b.registry))
query("consolidated_pl", ELIM + f""", el as (select period_key, consolidation_group, sum(case when pl_line_item = 'Revenue' then eliminated_amount else 0 end) ic_revenue_eliminated,
  sum(case when pl_line_item = 'COGS' then eliminated_amount else 0 end) ic_cogs_eliminated, count(distinct pair_id) pair_count from elim join ents on entity_key = seller_key where elimination_type = 'REVENUE_EXPENSE' group by all),
 g as (select period_key, consolidation_group, count(distinct p.entity_key) entity_count, sum(revenue) revenue, sum(cogs) cogs, sum(opex_total) opex_total, sum(net_profit) net_profit
  from t_pl p join ents e on p.entity_key = e.entity_key where consolidation_scope = 'entity' group by all)
 select g.period_key, g.consolidation_group, entity_count, coalesce(pair_count, 0) pair_count, {dec('revenue')} gross_revenue, {dec('coalesce(ic_revenue_eliminated, 0)')} ic_revenue_eliminated, {dec('revenue - coalesce(ic_revenue_eliminated, 0)')} consolidated_revenue,
 {dec('cogs - coalesce(ic_cogs_eliminated, 0)')} consolidated_cogs, {dec('opex_total')} opex_total, {dec('net_profit')} net_profit,
 {sql_ratio('(revenue - coalesce(ic_revenue_eliminated, 0) - cogs + coalesce(ic_cogs_eliminated, 0))', '(revenue - coalesce(ic_revenue_eliminated, 0))', 4, 100)} gross_margin_pct
 from g left join el on g.period_key = el.period_key and g.consolidation_group = el.consolidation_group""")(
    lambda b: con.consolidated_pl(b.pl, b.entities, con.ic_eliminations(b.ledger(accounts=K.IC_ACCOUNTS), b.registry)))
query("consolidation_by_method", """select period_key, consolidation_group, method, count(*) entities, round(sum(round(cast(revenue as double) * share * (1 + 1e-12), 2)), 2) consolidated_revenue,
 round(sum(round(cast(net_profit as double) * share * (1 + 1e-12), 2)), 2) consolidated_net_profit, round(sum(case when method = 'PROPORTIONAL' then round(cast(net_profit as double) * (1 - share) * (1 + 1e-12), 2) else 0 end), 2) minority_interest
 from t_pl p join ents e on p.entity_key = e.entity_key where consolidation_scope = 'entity' and method <> 'EQUITY' group by all""")(
    lambda b: con.consolidation_by_method(b.pl, b.entities))
query("ic_pair_completeness", ELIM + """, t as (select pair_id, sum(case when pl_line_item in ('Revenue', 'Receivable') then eliminated_amount end) sold, sum(case when pl_line_item in ('COGS', 'Payable') then eliminated_amount end) bought from elim group by all)
 select r.pair_id, r.transaction_type, cast(coalesce(sold, 0) as decimal(38,2)) sold, cast(coalesce(bought, 0) as decimal(38,2)) bought, cast((sold is not null)::int + (bought is not null)::int as integer) sides_present,
 case when sold is not null and bought is not null and abs(sold - bought) < 1 then 'OK' when sold is null and bought is null then 'NO_ACTIVITY' else 'OUT_OF_BALANCE' end status
 from reg r left join t on t.pair_id = r.pair_id where is_active""")(
    lambda b: con.ic_pair_completeness(b.ledger(accounts=K.IC_ACCOUNTS), b.registry))
