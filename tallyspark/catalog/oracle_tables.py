"""The derived books as plain SQL tables, written independently of the DataFrame code; used only to check results."""

from ..plans import constants as K

TIE = "(1 + 1e-12)"


def ratio(num, den, places=None, scale=1.0, otherwise="null"):
    value = f"cast({num} as double) / cast({den} as double) * cast({scale} as double)"
    if places is not None:
        value = f"round(({value}) * {TIE}, {places})"
    return f"case when ({den}) <> 0 then {value} else {otherwise} end"


def rnd(expr, places):
    return f"round(cast({expr} as double) * {TIE}, {places})"


def dec(expr):
    return f"cast({expr} as decimal(38,2))"


def times(expr, rate):
    return f"cast(round(cast({expr} as decimal(18,2)) * cast({rate} as decimal(16,6)), 2) as decimal(18,2))"


def _hundredths(expr):
    return f"cast(cast({expr} as decimal(18,2)) * 100 as hugeint)"


def _in_whole_numbers(expr, product, rate):
    by = f"cast(cast({rate} as decimal(16,6)) * 1000000 as hugeint)"
    return f"cast(cast(sign({expr}) * ((2 * {product} + {by}) // (2 * {by})) as decimal(20,0)) * 0.01::decimal(3,2) as decimal(18,2))"


def over(expr, rate):
    return _in_whole_numbers(expr, f"abs({_hundredths(expr)}) * 1000000", rate)


def crossed(expr, own, target):
    return _in_whole_numbers(expr, f"abs({_hundredths(expr)}) * cast(cast({own} as decimal(16,6)) * 1000000 as hugeint)", target)


def _values(rows, cols):
    return K.values_sql(rows, cols).replace("CAST(NULL AS STRING)", "CAST(NULL AS VARCHAR)")


def _legs():
    arms = []
    for leg, poster, d, c, d_ic, c_ic, amt in K.LEGS:
        other = "buyer" if poster == "seller" else "seller"
        for side, plain, inter in (("D", d, d_ic), ("C", c, c_ic)):
            deb, cre = (amt, "cast(0 as decimal(18,2))") if side == "D" else ("cast(0 as decimal(18,2))", amt)
            arms.append(
                f"select '{leg}' leg, '{side}' side, {poster}_key entity_key, {poster}_code entity_code, {other}_key counterparty_key, "
                f"case when is_intercompany then '{inter}' else '{plain}' end account_code, {deb} debit, {cre} credit, b.* "
                f"from base_lines b where {amt} is not null")
    return " union all ".join(arms)


P = "cast(l.l_extendedprice as decimal(18,2))"
NET = f"cast({P} * (1 - cast(l.l_discount as decimal(4,2))) as decimal(18,2))"
D18 = lambda e: f"cast({e} as decimal(18,2))"

TABLES: dict[str, str] = {}
TABLES["coa"] = _values(K.ACCOUNTS, K.ACCOUNT_COLUMNS)
TABLES["coa2"] = _values(K.ACCOUNTS_V2, K.ACCOUNT_COLUMNS)
TABLES["ccy"] = _values(K.CURRENCIES, ["currency_code", "region_key", "base_rate"])
TABLES["ents"] = """select cast(n_nationkey as integer) entity_key, n_name entity_code, cast(n_regionkey as integer) region_key,
 r_name consolidation_group, case when n_nationkey <> parent then cast(parent as integer) end parent_key,
 case when n_nationkey % 11 = 5 then 'EQUITY' when n_nationkey % 7 = 3 then 'PROPORTIONAL' else 'FULL' end method,
 case when n_nationkey % 11 = 5 then 0.0::double when n_nationkey % 7 = 3 then 0.5::double else 1.0::double end share
 from (select *, min(n_nationkey) over (partition by n_regionkey) parent from nation) join region on n_regionkey = r_regionkey"""
TABLES["quotes"] = """select cast(o_orderdate as date) rate_date, currency_code, o_orderkey, base_rate
 from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join ccy on region_key = n_regionkey
 where currency_code <> 'HUF' and isodow(o_orderdate) < 6 and not (currency_code = 'USD' and dayofyear(o_orderdate) between 100 and 104)"""
TABLES["rates"] = """select rate_date, currency_code, cast(base_rate + cast(max(o_orderkey) % 200 as decimal(16,6)) / 100 as decimal(16,6)) rate_to_huf
 from quotes group by rate_date, currency_code, base_rate"""
TABLES["base_lines"] = f"""select l.l_orderkey orderkey, l.l_linenumber linenumber, l.l_partkey partkey, l.l_suppkey suppkey, l.l_returnflag returnflag,
 cast(l.l_shipdate as date) posting_date, cast(o.o_orderdate as date) document_date,
 cast(year(l.l_shipdate) * 100 + month(l.l_shipdate) as integer) period_key,
 cast(ns.n_nationkey as integer) seller_key, ns.n_name seller_code, cast(nb.n_nationkey as integer) buyer_key, nb.n_name buyer_code,
 cast(nb.n_regionkey as integer) buyer_region, (ns.n_regionkey = nb.n_regionkey and ns.n_nationkey <> nb.n_nationkey) is_intercompany,
 p.p_type cost_centre, case when l.l_linenumber <= 3 then p.p_brand end project,
 {NET} a_sale, {D18(P + ' * 0.60')} a_cost,
 case when l.l_partkey % 97 <> 0 then {D18(P + ' * cast(l.l_tax as decimal(4,2))')} end a_other,
 case when l.l_partkey % 97 = 0 then {D18(P + ' * cast(l.l_tax as decimal(4,2))')} end a_unmapped,
 {D18('cast(l.l_quantity as decimal(10,2)) * 100')} a_payroll,
 case when l.l_returnflag = 'A' then {D18(P + ' * 0.020')} end a_depr,
 case when l.l_returnflag = 'R' then {D18(P + ' * 0.010')} end a_intexp,
 case when l.l_returnflag = 'N' then {D18(P + ' * 0.005')} end a_intinc,
 case when l.l_linestatus = 'F' then {D18(NET + ' * 0.03')} end a_tax,
 case when l.l_linestatus = 'F' and not (ns.n_regionkey = nb.n_regionkey and ns.n_nationkey <> nb.n_nationkey) then {D18(NET + ' * 0.80')} end a_receipt,
 case when o.o_orderpriority = '1-URGENT' then {D18(P + ' * 0.050')} end a_capex,
 {D18(P + ' * 0.700')} a_goods,
 case when ns.n_regionkey = nb.n_regionkey and ns.n_nationkey <> nb.n_nationkey then {NET} end a_icbuy
 from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey
 join supplier s on l.l_suppkey = s.s_suppkey join nation ns on s.s_nationkey = ns.n_nationkey join nation nb on c.c_nationkey = nb.n_nationkey
 left join part p on l.l_partkey = p.p_partkey"""
TABLES["reg"] = f"""select cast(seller_key as bigint) * {K.PAIR_STEP} + buyer_key * 10 + no pair_id, seller_key, buyer_key, seller_account, buyer_account, transaction_type, elimination_type,
 (seller_key + buyer_key) % 9 <> 0 is_active, make_date(1995 + seller_key % 3, 1, 1) valid_from, case when buyer_key % 4 = 0 then date '1999-12-31' end valid_to
 from (select distinct seller_key, buyer_key from base_lines where is_intercompany),
 (values {', '.join(str((i, *t)) for i, t in enumerate(K.IC_TYPES))}) t(no, transaction_type, elimination_type, seller_account, buyer_account)"""
TABLES["gl"] = f"""select cast(orderkey as varchar) || '-' || cast(linenumber as varchar) || '-' || cast(partkey as varchar) || '-' || cast(suppkey as varchar) || '-' || leg || '-' || side transaction_id,
 cast(orderkey as varchar) || '-' || cast(linenumber as varchar) source_id, leg, side, entity_key, entity_code, counterparty_key, account_code, debit, credit,
 cast(debit - credit as decimal(18,2)) net, posting_date, document_date, cast(posting_date + cast(partkey % 40 as integer) as date) ingestion_date, period_key,
 cast(partkey % 24 as integer) posting_hour, cast(orderkey as varchar) document_number, cast(period_key as varchar) || '-' || entity_code batch_id,
 case suppkey % 3 when 0 then 'COBALT' when 1 then 'SAP_B1' else 'SZAMLAZZ' end source_system, currency_code,
 {over('debit', 'base_rate')} debit_fcy,
 {over('credit', 'base_rate')} credit_fcy,
 is_intercompany, (returnflag = 'R' and linenumber = 7) is_reversal, partkey, cost_centre, project
 from ({_legs()}) join ccy on region_key = buyer_region"""
TABLES["tb"] = f"""select entity_key, period_key, account_code, is_intercompany, sum(debit) debit, sum(credit) credit, sum(net) net,
 sum({over('net', 'coalesce(rate_to_huf, 400)')}) net_eur, count(*) postings
 from gl left join rates r on r.rate_date = posting_date and r.currency_code = 'EUR' group by all"""
TABLES["tbx"] = f"""select entity_key, period_key, account_code, is_intercompany, cost_centre, project, sum(debit) debit, sum(credit) credit, sum(net) net,
 sum({over('net', 'coalesce(rate_to_huf, 400)')}) net_eur, count(*) postings
 from gl left join rates r on r.rate_date = posting_date and r.currency_code = 'EUR' group by all"""
TABLES["tbm"] = """select t.*, c.* exclude (account_code),
 case when account_type = 'Revenue' then -net else net end signed from tb t join coa c on t.account_code = c.account_code"""
_MI = "(period_key // 100) * 12 + period_key % 100 - 1"
TABLES["bs_moves"] = f"""select entity_key, case when left(account_code, 1) in ('1','2','3','4') then account_code else '419' end account_code,
 {_MI} mi, sum(net) movement from tb group by all"""
TABLES["bs_up"] = """select g.entity_key, cast(g.mi // 12 as integer) period_year, cast(g.mi % 12 + 1 as integer) period_month, g.account_code,
 cast(sum(coalesce(movement, 0)) over (partition by g.entity_key, g.account_code order by g.mi)
  + case when g.account_code = '382' and (g.entity_key + g.mi % 12 + 1) % 17 = 0 then 1000 else 0 end as decimal(38,2)) closing_balance,
 cast(sum(coalesce(movement, 0)) over (partition by g.entity_key, g.account_code order by g.mi) - coalesce(movement, 0) as decimal(38,2)) opening_balance
 from (select entity_key, account_code, unnest(range(min(mi), 2001 * 12 + 12)) mi from bs_moves group by 1, 2) g
 left join bs_moves m on m.entity_key = g.entity_key and m.account_code = g.account_code and m.mi = g.mi"""
TABLES["bs_stage"] = """select *, period_year * 100 + period_month period_key, cast(left(account_code, 1) as integer) account_class,
 case when left(account_code, 1) = '4' then 'C' else 'D' end normal_balance from bs_up"""
TABLES["bs_nodes"] = """select cast(period_key as integer) period_key, entity_key, universal_node, account_type, l1_category, l2_subcategory,
 cast(sum(case when s.normal_balance = 'C' then -closing_balance else closing_balance end) as decimal(38,2)) closing_balance,
 cast(sum(closing_balance - opening_balance) as decimal(38,2)) period_movement
 from bs_stage s join coa on s.account_code = coa.account_code group by all"""
TABLES["bud_up"] = """select entity_key, cast(period_key // 100 as integer) period_year, cast(period_key % 100 as integer) period_month, account_code,
 case when (entity_key + period_key % 100) % 2 = 0 then a else b end budget_version,
 cast(py * case when (entity_key + period_key % 100) % 13 = 0 then f_small else f end as decimal(38,2)) budget_amount
 from (select entity_key, account_code, period_key + 100 period_key, cast(sum(signed) as decimal(28,2)) py from tbm
   where l1_category in ('Revenue', 'COGS', 'OPEX') group by entity_key, account_code, period_key)
 cross join (values ('BUDGET', 'original_budget', 1.05::decimal(8,5), 0.00105::decimal(8,5)), ('Revised', 'REVISED_BUDGET', 1.02::decimal(8,5), 0.00102::decimal(8,5)),
   ('FORECAST', 'rolling_forecast', 0.98::decimal(8,5), 0.00098::decimal(8,5))) v(a, b, f, f_small)"""
_FOLDED = " ".join(f"when '{alias}' then '{version}'" for alias, version in K.BUDGET_ALIASES.items())
TABLES["bud"] = f"""select entity_key, cast(period_year * 100 + period_month as integer) period_key, account_code,
 case upper(budget_version) {_FOLDED} else 'ORIGINAL_BUDGET' end budget_version, budget_amount
 from bud_up where budget_amount is not null"""
TABLES["accesslog"] = "select event_id, ts event_ts, user_id, event_type action, value, props from events"
TABLES["usermap"] = """select user_id, entity_key, entity_code, user_id % 10 <> 0 is_active,
 case user_id % 3 when 0 then 'CEO' when 1 then 'CFO' else 'AUDITOR' end "role"
 from (select distinct user_id from events) join ents on entity_key % 5 = user_id % 5"""

# ---- statements -------------------------------------------------------------------------------------------------
_PL = {"revenue": ("l1_category = 'Revenue'", "signed"), "cogs": ("l1_category = 'COGS'", "signed"),
       "opex_total": ("l1_category = 'OPEX'", "signed"), "depreciation_amortisation": ("pl_line_item = 'DA'", "signed"),
       "financial_income": ("pl_line_item = 'Fin_Income'", "signed"), "financial_expense": ("pl_line_item = 'Fin_Expense'", "signed"),
       "tax_expense": ("pl_line_item = 'Tax'", "signed"), "revenue_eur": ("l1_category = 'Revenue'", "net_eur")}


def _sums(extra=""):
    return ", ".join(f"cast(sum(case when {c}{extra} then {v} else 0 end) as decimal(38,2)) {n}" for n, (c, v) in _PL.items())


TABLES["t_act"] = f"""select period_key, entity_key, 'entity' consolidation_scope, {_sums()} from tbm group by period_key, entity_key
 union all select period_key, entity_key, 'group', {_sums(' and not is_intercompany')} from tbm group by period_key, entity_key"""
TABLES["t_bline"] = """select period_key, entity_key, b.account_code, l1_category, pl_line_item, cast(sum(budget_amount) as decimal(38,2)) budget_amount
 from bud b join coa c on b.account_code = c.account_code where budget_version = 'ORIGINAL_BUDGET' group by all"""
TABLES["t_btot"] = """select period_key, entity_key, cast(sum(case when l1_category = 'Revenue' then budget_amount else 0 end) as decimal(38,2)) revenue_budget,
 cast(sum(case when l1_category = 'COGS' then budget_amount else 0 end) as decimal(38,2)) cogs_budget,
 cast(sum(case when l1_category = 'OPEX' then budget_amount else 0 end) as decimal(38,2)) opex_budget,
 cast(sum(case when l1_category = 'OPEX' and pl_line_item <> 'DA' then budget_amount else 0 end) as decimal(38,2)) cash_opex_budget
 from t_bline group by all"""
TABLES["t_pl"] = f"""select a.*, a.revenue - a.cogs gross_profit, {ratio('(a.revenue - a.cogs)', 'a.revenue', 4, 100, '0')} gross_margin_pct,
 a.revenue - a.cogs - a.opex_total ebit, a.revenue - a.cogs - a.opex_total + a.depreciation_amortisation ebitda,
 {ratio('(a.revenue - a.cogs - a.opex_total + a.depreciation_amortisation)', 'a.revenue', 4, 100, '0')} ebitda_margin_pct,
 a.financial_income - a.financial_expense net_financial_items,
 a.revenue - a.cogs - a.opex_total + a.financial_income - a.financial_expense - a.tax_expense net_profit,
 b.revenue_budget, b.cogs_budget, a.revenue - b.revenue_budget revenue_variance,
 {ratio('(a.revenue - b.revenue_budget)', 'b.revenue_budget', 4, 100)} revenue_variance_pct, y.revenue revenue_py, a.revenue - y.revenue revenue_yoy,
 {ratio('(a.revenue - y.revenue)', 'y.revenue', 4, 100)} revenue_yoy_pct
 from t_act a left join t_btot b on a.period_key = b.period_key and a.entity_key = b.entity_key
 left join t_act y on a.period_key = y.period_key + 100 and a.entity_key = y.entity_key and a.consolidation_scope = y.consolidation_scope"""
_CS = lambda cond, n: f"cast(sum(case when {cond} then signed else 0 end) as decimal(38,2)) {n}"
TABLES["t_comp0"] = f"""select *, revenue - cogs gross_profit, opex_personnel + opex_depreciation + opex_other opex_total,
 revenue - cogs + other_operating_income - opex_personnel - opex_other ebitda,
 revenue - cogs + other_operating_income - opex_personnel - opex_other - opex_depreciation ebit, financial_expense - financial_income net_interest_expense,
 revenue - cogs + other_operating_income - opex_personnel - opex_other - opex_depreciation + financial_income - financial_expense profit_before_tax,
 revenue - cogs + other_operating_income - opex_personnel - opex_other - opex_depreciation + financial_income - financial_expense - tax_expense net_profit
 from (select period_key, entity_key, {_CS("l1_category = 'Revenue'", 'revenue')}, {_CS("pl_line_item = 'Other Operating Income'", 'other_operating_income')},
 {_CS("l1_category = 'COGS'", 'cogs')}, {_CS("l2_subcategory = 'Payroll' and l1_category = 'OPEX'", 'opex_personnel')}, {_CS("pl_line_item = 'DA'", 'opex_depreciation')},
 {_CS("l1_category = 'OPEX' and l2_subcategory not in ('Payroll', 'Depreciation')", 'opex_other')}, {_CS("pl_line_item = 'Fin_Income'", 'financial_income')},
 {_CS("pl_line_item = 'Fin_Expense'", 'financial_expense')}, {_CS("pl_line_item = 'Tax'", 'tax_expense')}, cast(sum(postings) as bigint) transaction_count
 from tbm group by all)"""
_YTD = lambda n: f"cast(sum({n}) over (partition by a.entity_key, a.period_key // 100 order by a.period_key rows unbounded preceding) as decimal(38,2))"
TABLES["t_comp"] = f"""select a.*, {ratio('a.gross_profit', 'a.revenue', 4, 1, '0')} gross_margin_ratio, {ratio('a.ebitda', 'a.revenue', 4, 1, '0')} ebitda_margin_ratio,
 {ratio('a.ebit', 'a.revenue', 4, 1, '0')} ebit_margin_ratio, {ratio('a.net_profit', 'a.revenue', 4, 1, '0')} net_profit_margin_ratio,
 b.revenue_budget, b.cogs_budget, b.opex_budget, b.revenue_budget - b.cogs_budget - b.cash_opex_budget ebitda_budget,
 b.revenue_budget - b.cogs_budget - b.opex_budget net_profit_budget, y.revenue revenue_py, y.ebitda ebitda_py, y.net_profit net_profit_py,
 a.revenue - b.revenue_budget revenue_variance, {ratio('(a.revenue - b.revenue_budget)', 'b.revenue_budget', 4)} revenue_variance_ratio,
 a.ebitda - (b.revenue_budget - b.cogs_budget - b.cash_opex_budget) ebitda_variance,
 {ratio('(a.ebitda - (b.revenue_budget - b.cogs_budget - b.cash_opex_budget))', '(b.revenue_budget - b.cogs_budget - b.cash_opex_budget)', 4)} ebitda_variance_ratio,
 {ratio('(a.revenue - y.revenue)', 'y.revenue', 4)} revenue_yoy_ratio, {ratio('(a.ebitda - y.ebitda)', 'y.ebitda', 4)} ebitda_yoy_ratio,
 {_YTD('a.revenue')} revenue_ytd, {_YTD('a.ebitda')} ebitda_ytd, {_YTD('a.net_profit')} net_profit_ytd, {_YTD('b.revenue_budget')} revenue_budget_ytd, {_YTD('y.revenue')} revenue_py_ytd
 from t_comp0 a left join t_btot b on a.period_key = b.period_key and a.entity_key = b.entity_key
 left join t_comp0 y on a.period_key = y.period_key + 100 and a.entity_key = y.entity_key"""
_CB = lambda cond, n, v="closing_balance", sign="": f"{sign}cast(sum(case when {cond} then {v} else 0 end) as decimal(38,2)) {n}"
_N = lambda p: f"universal_node like '{p}%'"
TABLES["t_buckets"] = f"""select period_key, entity_key, {_CB(_N('ASSET.CURRENT'), 'current_assets')}, {_CB(_N('ASSET.CURRENT.CASH'), 'cash')},
 {_CB(_N('ASSET.CURRENT.RECEIVABLES'), 'trade_receivables')}, {_CB(_N('ASSET.CURRENT.INVENTORY'), 'inventory')}, {_CB(_N('ASSET.NONCURRENT'), 'noncurrent_assets')},
 {_CB(_N('LIABILITY.CURRENT'), 'current_liabilities')}, {_CB(_N('LIABILITY.CURRENT.PAYABLES'), 'trade_payables')}, {_CB(_N('LIABILITY.NONCURRENT'), 'noncurrent_liabilities')},
 {_CB(_N('LIABILITY.NONCURRENT.DEBT') + ' or ' + _N('LIABILITY.CURRENT.DEBT'), 'total_debt')}, {_CB("account_type = 'Equity'", 'total_equity')},
 {_CB("account_type = 'Asset'", 'total_assets')} from bs_nodes group by all"""
TABLES["t_wide0"] = f"""select *, intangible_assets + tangible_assets + financial_investments total_fixed_assets, trade_receivables + other_receivables total_receivables,
 inventory + trade_receivables + other_receivables + securities + cash_and_equivalents total_current_assets, share_capital + retained_earnings + profit_for_period total_equity,
 short_term_debt + trade_payables + other_current_liabilities total_current_liabilities, long_term_debt + short_term_debt - cash_and_equivalents net_debt
 from (select period_key, entity_key, {_CB(_N('ASSET.NONCURRENT.INTANGIBLE'), 'intangible_assets')},
 {_CB(_N('ASSET.NONCURRENT.PPE') + ' or ' + _N('ASSET.NONCURRENT.ACCUMULATED'), 'tangible_assets')}, {_CB(_N('ASSET.NONCURRENT.FINANCIAL'), 'financial_investments')},
 {_CB(_N('ASSET.CURRENT.INVENTORY'), 'inventory')}, {_CB(_N('ASSET.CURRENT.RECEIVABLES.TRADE'), 'trade_receivables')},
 {_CB(_N('ASSET.CURRENT.RECEIVABLES') + " and universal_node not like 'ASSET.CURRENT.RECEIVABLES.TRADE%'", 'other_receivables')}, {_CB(_N('ASSET.CURRENT.SECURITIES'), 'securities')},
 {_CB(_N('ASSET.CURRENT.CASH'), 'cash_and_equivalents')}, {_CB(_N('ASSET.CURRENT.PREPAYMENTS'), 'accrued_income')}, {_CB(_N('EQUITY.SHARE_CAPITAL'), 'share_capital')},
 {_CB(_N('EQUITY.RETAINED_EARNINGS'), 'retained_earnings')}, {_CB(_N('EQUITY.CURRENT_YEAR_PROFIT'), 'profit_for_period')}, {_CB(_N('LIABILITY.NONCURRENT.DEBT'), 'long_term_debt')},
 {_CB(_N('LIABILITY.CURRENT.DEBT'), 'short_term_debt')}, {_CB(_N('LIABILITY.CURRENT.PAYABLES'), 'trade_payables')}, {_CB(_N('LIABILITY.CURRENT.OTHER'), 'other_current_liabilities')}
 from bs_nodes group by all)"""
TABLES["t_wide1"] = """select *, total_fixed_assets + total_current_assets + accrued_income total_assets, total_equity + long_term_debt + total_current_liabilities total_liabilities_equity,
 total_current_assets - trade_payables - other_current_liabilities net_working_capital,
 total_fixed_assets + total_current_assets + accrued_income - (total_equity + long_term_debt + total_current_liabilities) balance_check from t_wide0"""
TABLES["t_wide"] = """select a.*, y.total_assets total_assets_py, y.total_equity total_equity_py, y.trade_receivables trade_receivables_py, y.inventory inventory_py,
 y.trade_payables trade_payables_py, y.cash_and_equivalents cash_and_equivalents_py
 from t_wide1 a left join t_wide1 y on a.entity_key = y.entity_key and a.period_key = y.period_key + 100"""
_CM = lambda cond, n, sign="": f"cast({sign}sum(case when {cond} then period_movement else 0 end) as decimal(38,2)) {n}"
_NOT = lambda p: f"universal_node not like '{p}%'"
TABLES["t_cfm"] = f"""select period_key, entity_key, {_CM(_N('ASSET.CURRENT.RECEIVABLES'), 'delta_receivables', '-')}, {_CM(_N('ASSET.CURRENT.INVENTORY'), 'delta_inventory', '-')},
 {_CM(_N('LIABILITY.CURRENT.PAYABLES'), 'delta_payables')},
 {_CM(' and '.join([_N('ASSET.CURRENT'), _NOT('ASSET.CURRENT.CASH'), _NOT('ASSET.CURRENT.RECEIVABLES'), _NOT('ASSET.CURRENT.INVENTORY')]), 'delta_other_current_assets', '-')},
 {_CM(_N('LIABILITY.CURRENT') + ' and ' + _NOT('LIABILITY.CURRENT.PAYABLES'), 'delta_other_current_liabilities')},
 {_CM(_N('ASSET.NONCURRENT.PPE') + ' or ' + _N('ASSET.NONCURRENT.INTANGIBLE'), 'capex', '-')}, {_CM(_N('ASSET.NONCURRENT.FINANCIAL'), 'financial_investments', '-')},
 {_CM(_N('LIABILITY.NONCURRENT.DEBT'), 'net_debt_change')}, {_CM(_N('EQUITY') + ' and ' + _NOT('EQUITY.RETAINED_EARNINGS'), 'equity_transactions')},
 cast(sum(closing_balance) filter (where {_N('ASSET.CURRENT.CASH')}) as decimal(38,2)) closing_cash,
 cast(sum(closing_balance - period_movement) filter (where {_N('ASSET.CURRENT.CASH')}) as decimal(38,2)) opening_cash from bs_nodes group by all"""
TABLES["t_cf"] = """select *, investing_cash_flow + financing_cash_flow + operating_cash_flow net_cash_movement from (
 select p.period_key, p.entity_key, p.consolidation_scope, p.net_profit, p.depreciation_amortisation add_back_da, m.* exclude (period_key, entity_key),
 net_profit + depreciation_amortisation + delta_receivables + delta_inventory + delta_payables + delta_other_current_assets + delta_other_current_liabilities operating_cash_flow,
 capex + financial_investments investing_cash_flow, net_debt_change + equity_transactions financing_cash_flow,
 net_profit + depreciation_amortisation + delta_receivables + delta_inventory + delta_payables + delta_other_current_assets + delta_other_current_liabilities + capex free_cash_flow
 from t_pl p left join t_cfm m on p.period_key = m.period_key and p.entity_key = m.entity_key)"""

# ---- ratios -----------------------------------------------------------------------------------------------------
TABLES["t_bslag"] = """select *, lag(total_assets) over w prior_total_assets, lag(total_equity) over w prior_total_equity, lag(cash) over w prior_cash
 from t_buckets window w as (partition by entity_key order by period_key)"""
TABLES["t_prof"] = f"""select p.period_key, p.entity_key, consolidation_scope, revenue, revenue_eur, gross_profit, gross_margin_pct, ebitda, ebitda_margin_pct, net_profit,
 {ratio('net_profit', 'revenue', 4, 100)} net_profit_margin_pct,
 {ratio('net_profit', '(cast(total_assets + prior_total_assets as double) / 2)', 4, 100)} roa_pct, {ratio('net_profit', '(cast(total_equity + prior_total_equity as double) / 2)', 4, 100)} roe_pct,
 total_assets, total_equity, total_debt, cash, total_debt - cash net_debt, total_equity + total_debt - cash invested_capital,
 {ratio('(cast(ebit as double) * (1 - 0.09::double))', '(total_equity + total_debt - cash)', 4, 100)} roic_pct,
 revenue_budget, revenue_variance, revenue_variance_pct, revenue_py, revenue_yoy, revenue_yoy_pct
 from t_pl p left join t_bslag b on p.period_key = b.period_key and p.entity_key = b.entity_key"""
_D30 = lambda b, f: f"cast({b} as double) / (cast({f} as double) / 30.0::double)"
_RN = lambda e, n: f"round(({e}) * {TIE}, {n})"
TABLES["t_liq"] = f"""select b.period_key, b.entity_key, s.consolidation_scope, {ratio('current_assets', 'current_liabilities', 4)} current_ratio,
 {ratio('(current_assets - inventory)', 'current_liabilities', 4)} quick_ratio,
 case when revenue <> 0 then {_RN(_D30('trade_receivables', 'revenue'), 1)} end dso_days, case when cogs <> 0 then {_RN(_D30('trade_payables', 'cogs'), 1)} end dpo_days,
 case when cogs <> 0 then {_RN(_D30('inventory', 'cogs'), 1)} end dio_days,
 case when revenue <> 0 and cogs <> 0 then {_RN(_D30('trade_receivables', 'revenue') + ' + ' + _D30('inventory', 'cogs') + ' - ' + _D30('trade_payables', 'cogs'), 1)} end cash_conversion_cycle_days,
 total_debt - cash net_debt, cast(ebitda_ltm as decimal(38,2)) ebitda_ltm, {ratio('(total_debt - cash)', 'ebitda_ltm', 2)} net_debt_ebitda,
 case when net_financial_items < 0 then {ratio('ebit', 'abs(net_financial_items)', 2)} end interest_coverage,
 {ratio('total_equity', 'total_assets', 2, 100)} equity_ratio_pct, {ratio('(total_debt - cash)', '(total_debt - cash + total_equity)', 2, 100)} gearing_ratio_pct,
 current_assets, current_liabilities, trade_receivables, inventory, trade_payables, total_debt, total_equity, total_assets, cash,
 operating_cash_flow, free_cash_flow, capex, {ratio('abs(capex)', 'revenue', 2, 100)} capex_intensity_pct
 from t_buckets b cross join (values ('entity'), ('group')) s(consolidation_scope)
 left join (select *, sum(ebitda) over (partition by entity_key, consolidation_scope order by period_key rows between 11 preceding and current row) ebitda_ltm from t_pl) p
  on p.period_key = b.period_key and p.entity_key = b.entity_key and p.consolidation_scope = s.consolidation_scope
 left join (select period_key pk, entity_key ek, consolidation_scope cs, operating_cash_flow, free_cash_flow, capex from t_cf) f
  on f.pk = b.period_key and f.ek = b.entity_key and f.cs = s.consolidation_scope"""
_ANN = lambda b, f: f"cast({b} as double) / (cast({f} as double) * 12 / 365.0::double)"
_STOCK = "coalesce(cast(inventory + inventory_py as double) / 2, cast(inventory as double))"
_SVC = "(abs(coalesce(cast(debt_repayments as double), 0)) + coalesce(cast(net_interest_expense as double), 0))"
_DEBTBASE = "coalesce(cast(ebitda_ytd as double), cast(ebitda_py as double), cast(ebitda as double) * 12)"
TABLES["t_liqa"] = f"""select w.period_key, w.entity_key, case when revenue <> 0 then {_RN(_ANN('trade_receivables', 'revenue'), 4)} end dso_days,
 case when cogs <> 0 then {_RN(_ANN('inventory', 'cogs'), 4)} end dio_days, case when cogs <> 0 then {_RN(_ANN('trade_payables', 'cogs'), 4)} end dpo_days,
 case when revenue <> 0 and cogs <> 0 then {_RN(_ANN('trade_receivables', 'revenue') + ' + ' + _ANN('inventory', 'cogs') + ' - ' + _ANN('trade_payables', 'cogs'), 4)} end cash_conversion_cycle,
 {ratio('net_debt', _DEBTBASE, 4)} net_debt_to_ebitda, {ratio('ebit', 'net_interest_expense', 4)} interest_coverage,
 case when {_SVC} > 0 then {ratio('ebitda', _SVC, 4)} end debt_service_coverage, {ratio('total_equity', 'total_assets', 4, 100)} equity_ratio_pct,
 {ratio('net_debt', '(net_debt + total_equity)', 4)} gearing_ratio, {ratio('(cast(cogs as double) * 12)', _STOCK, 4)} inventory_turnover,
 {ratio('(cast(gross_profit as double) * 12)', _STOCK, 4)} gmroi
 from t_wide w left join (select period_key pk, entity_key ek, revenue, cogs, gross_profit, ebitda, ebitda_ytd, ebitda_py, ebit, net_interest_expense from t_comp) p on p.pk = w.period_key and p.ek = w.entity_key
 left join (select period_key pk2, entity_key ek2, least(net_debt_change, 0) debt_repayments from t_cf where consolidation_scope = 'entity') f on f.pk2 = w.period_key and f.ek2 = w.entity_key"""
TABLES["t_dso3"] = f"""select b.period_key, b.entity_key, {ratio('trade_receivables', '(cast(r3 as double) / 90)', 4)} dso_days, {ratio('trade_payables', '(cast(c3 as double) / 90)', 4)} dpo_days
 from t_buckets b left join (select period_key pk, entity_key ek, sum(revenue) over w r3, sum(cogs) over w c3 from t_pl where consolidation_scope = 'entity'
  window w as (partition by entity_key order by (period_key // 100) * 12 + period_key % 100 range between 2 preceding and current row)) p on pk = b.period_key and ek = b.entity_key"""
TABLES["t_ck"] = f"""select c.period_key, c.entity_key, c.consolidation_scope, operating_cash_flow, investing_cash_flow, financing_cash_flow, net_cash_movement, free_cash_flow, capex,
 {ratio('operating_cash_flow', 'revenue', 2, 100)} ocf_margin_pct, {ratio('abs(capex)', 'revenue', 2, 100)} capex_intensity_pct, {ratio('operating_cash_flow', 'ebitda', 2, 100)} cf_conversion_pct,
 cast(case when operating_cash_flow < 0 then abs(operating_cash_flow) else 0 end as decimal(38,2)) monthly_burn_rate,
 case when operating_cash_flow < 0 then {ratio('b.cash', 'abs(operating_cash_flow)', 1)} end cash_runway_months,
 case when operating_cash_flow > 0 then {ratio('abs(capex)', 'operating_cash_flow', 2, 100)} end reinvestment_rate_pct,
 case when free_cash_flow < 0 then abs(free_cash_flow) end cash_burn_rate_fcf, {ratio('free_cash_flow', 'revenue', 4, 100)} fcf_margin_pct,
 cast(sum(operating_cash_flow) over w as decimal(38,2)) ocf_ltm, cast(sum(free_cash_flow) over w as decimal(38,2)) fcf_ltm, cast(sum(capex) over w as decimal(38,2)) capex_ltm,
 {ratio('(sum(free_cash_flow) over w)', 'revenue', 2, 100)} fcf_margin_ltm_pct, b.cash cash_and_equivalents, b.prior_cash prior_cash_balance,
 b.cash - coalesce(b.prior_cash, 0) cash_movement_period
 from t_cf c left join (select period_key pk, entity_key ek, consolidation_scope cs, revenue, ebitda from t_pl) p on pk = c.period_key and ek = c.entity_key and cs = c.consolidation_scope
 left join t_bslag b on b.period_key = c.period_key and b.entity_key = c.entity_key
 window w as (partition by c.entity_key, c.consolidation_scope order by c.period_key rows between 11 preceding and current row)"""
_PA = "t.account_code = c.account_code"
TABLES["t_proj0"] = f"""select t.period_key, t.entity_key, t.project, sum(t.postings) postings,
 cast(sum(case when l1_category = 'Revenue' then -net else 0 end) as decimal(38,2)) project_revenue, cast(sum(case when l1_category = 'COGS' then net else 0 end) as decimal(38,2)) project_cogs,
 cast(sum(case when l1_category in ('COGS', 'OPEX') and (l2_subcategory like '%Labour%' or l2_subcategory like '%Payroll%' or l2_subcategory like '%Salary%') then net else 0 end) as decimal(38,2)) project_labour_cost,
 cast(sum(case when l1_category = 'OPEX' and l2_subcategory not like '%Labour%' and l2_subcategory not like '%Payroll%' and l2_subcategory not like '%Salary%' then net else 0 end) as decimal(38,2)) project_nonlabour_cost,
 cast(sum(case when l1_category in ('COGS', 'OPEX') then net else 0 end) as decimal(38,2)) project_total_cost,
 cast(sum(case when l1_category = 'Revenue' then -net_eur else 0 end) as decimal(38,2)) project_revenue_eur,
 cast(sum(case when l1_category in ('COGS', 'OPEX') then net_eur else 0 end) as decimal(38,2)) project_total_cost_eur,
 cast(sum(case when account_type = 'Expense' then net else 0 end) as decimal(38,2)) project_expense
 from tbx t join coa c on {_PA} where project is not null group by all"""
TABLES["t_projbud"] = """select cast(period_key // 100 + 1 as integer) fiscal_year, entity_key, project, cast(sum(project_total_cost) * 1.02::decimal(4,2) as decimal(38,2)) project_budget from t_proj0 group by all"""
_PY = lambda c: f"cast(sum({c}) over (partition by p.entity_key, p.project, p.period_key // 100 order by p.period_key rows unbounded preceding) as decimal(38,2))"
TABLES["t_proj"] = f"""select *, project_revenue - project_cogs project_gross_profit, {ratio('(project_revenue - project_cogs)', 'project_revenue', 2, 100)} project_gross_margin_pct,
 {ratio('project_labour_cost', 'project_total_cost', 2, 100)} labour_cost_share_pct, ytd_revenue - ytd_total_cost ytd_project_profit, ytd_total_cost - coalesce(project_budget, 0) ytd_cost_vs_budget,
 {ratio('(ytd_total_cost - project_budget)', 'abs(project_budget)', 2, 100)} ytd_cost_overrun_pct,
 coalesce(project_budget > 0 and ytd_total_cost > project_budget * 1.05, false) is_cost_overrun from (
 select p.* exclude (postings, project_expense), cast(p.period_key // 100 as integer) fiscal_year, {_PY('project_revenue')} ytd_revenue, {_PY('project_total_cost')} ytd_total_cost, {_PY('project_labour_cost')} ytd_labour_cost, b.project_budget
 from t_proj0 p left join t_projbud b on b.fiscal_year = p.period_key // 100 and b.entity_key = p.entity_key and b.project = p.project)"""
