"""Measures, alerts, versioned mappings, restatements, queues and fact packs."""

from functools import reduce

from pyspark.sql import Observation, functions as F

from ..operators import alerts as A, dq, history as H, measures as M, reporting as R, staging
from ..operators.statements import KEY
from ..plans import constants as K
from ..session import cut_lineage, fresh_path
from .oracle_tables import TABLES, _values, dec, ratio as sql_ratio
from .registry import query

n = lambda: F.count("*").alias("n")  # built when a query runs: the registry loads without a session
summed = lambda *cols: [F.sum(c).alias(c) for c in cols]

# ---- measures -------------------------------------------------------------------------------------------------
_B = {
    "revenue": "gl|Revenue", "cogs": "gl|COGS", "personnel_expense": "gl|Personnel", "other_opex": "gl|Other OpEx", "other_operating_income": "gl|Other Operating Income",
    "financial_income": "gl|Fin_Income", "financial_expense": "gl|Fin_Expense", "tax_expense": "gl|Tax",
}
_gl = ", ".join(f"{dec(f'''sum(case when pl_line_item = '{v.split('|')[1]}' then signed else 0 end)''')} {k}" for k, v in _B.items())
_NODE = {"total_current_assets": "universal_node like 'ASSET.CURRENT%'", "total_non_current_assets": "universal_node like 'ASSET.NONCURRENT%'",
         "total_current_liabilities": "universal_node like 'LIABILITY.CURRENT%'", "total_non_current_liabilities": "universal_node like 'LIABILITY.NONCURRENT%'",
         "total_equity": "universal_node like 'EQUITY%'", "receivables": "universal_node like 'ASSET.CURRENT.RECEIVABLES.TRADE%'", "payables": "universal_node like 'LIABILITY.CURRENT.PAYABLES.TRADE%'"}
_FLOW = {"operating_cash_flow": "universal_node not like 'ASSET.CURRENT.CASH%' and universal_node not like 'ASSET.NONCURRENT%' and universal_node not like 'LIABILITY.NONCURRENT%' and universal_node not like 'LIABILITY.CURRENT.DEBT%'",
         "investing_cash_flow": "universal_node like 'ASSET.NONCURRENT%'", "financing_cash_flow": "universal_node like 'LIABILITY.NONCURRENT%' or universal_node like 'LIABILITY.CURRENT.DEBT%'",
         "capex": "universal_node like 'ASSET.NONCURRENT.PPE%'"}
_bs = ", ".join([f"{dec(f'sum(case when {c} then closing_balance else 0 end)')} {k}" for k, c in _NODE.items()] + [f"{dec(f'sum(case when {c} then -period_movement else 0 end)')} {k}" for k, c in _FLOW.items()])
_ALL = list(_B) + list(_NODE) + list(_FLOW)
TABLES["t_meas0"] = f"""select period_key, entity_key, {', '.join(f'coalesce({c}, 0) {c}' for c in _ALL)}, b.revenue_budget, b.revenue_budget - cogs_budget - cash_opex_budget ebitda_budget
 from (select period_key, entity_key, {_gl} from tbm group by all) g full join (select period_key, entity_key, {_bs} from bs_nodes group by all) s using (period_key, entity_key) full join t_btot b using (period_key, entity_key)"""
_EB = "(revenue - cogs + other_operating_income - personnel_expense - other_opex)"
_NP = "(revenue - cogs + other_operating_income - personnel_expense - other_opex + financial_income - financial_expense - tax_expense)"
_rag = lambda e: f"case when ({e}) is null then 'GREY' when ({e}) >= 0 then 'GREEN' when ({e}) >= -0.05 then 'AMBER' else 'RED' end"
_RV, _EV = sql_ratio('(revenue - revenue_budget)', 'revenue_budget', 6), sql_ratio(f'({_EB} - ebitda_budget)', 'abs(ebitda_budget)', 6)
_W3 = "(partition by entity_key order by (period_key // 100) * 12 + period_key % 100 range between 2 preceding and current row)"
_WY = "(partition by entity_key, period_key // 100 order by period_key rows unbounded preceding)"
_WP = "(partition by entity_key order by (period_key // 100) * 12 + period_key % 100 range between 12 preceding and 12 preceding)"
TABLES["t_meas"] = f"""select *, revenue - cogs gross_profit, {sql_ratio('(revenue - cogs)', 'revenue', 6)} gross_margin_pct, {_EB} ebitda, {sql_ratio(_EB, 'revenue', 6)} ebitda_margin_pct, {_NP} net_profit,
 total_current_assets + total_non_current_assets total_assets, total_current_liabilities + total_non_current_liabilities total_liabilities,
 {sql_ratio('(total_current_liabilities + total_non_current_liabilities)', 'total_equity', 6)} debt_to_equity, operating_cash_flow + capex free_cash_flow, total_current_assets - total_current_liabilities working_capital,
 {sql_ratio('total_current_assets', 'total_current_liabilities', 6)} current_ratio, revenue - revenue_budget revenue_variance, {_RV} revenue_variance_pct, {_EB} - ebitda_budget ebitda_variance, {_rag(_RV)} revenue_rag, {_rag(_EV)} ebitda_rag,
 {sql_ratio('receivables', f'(cast(sum(revenue) over {_W3} as double) / 90)', 4)} days_sales_outstanding, {sql_ratio('payables', f'(cast(sum(cogs) over {_W3} as double) / 90)', 4)} days_payable_outstanding,
 {dec(f'sum(revenue) over {_WY}')} revenue_ytd, {dec(f'sum({_EB}) over {_WY}')} ebitda_ytd, {dec(f'sum({_NP}) over {_WY}')} net_profit_ytd, {dec(f'sum(revenue) over {_WP}')} revenue_py,
 {sql_ratio(f'(revenue - sum(revenue) over {_WP})', f'abs(sum(revenue) over {_WP})', 6)} revenue_yoy_pct from t_meas0"""
measure_rows = lambda b: M.measure_frame(b.mapped, b.nodes, b.budget_lines)
HIDDEN = {"financial_income", "financial_expense", "tax_expense", "receivables", "payables"}
for _name in M.NAMES:
    if _name not in HIDDEN:
        query(f"m_{_name}", f"select entity_key, period_key, {_name} from t_meas")(
            lambda b, name=_name: M.evaluate(measure_rows(b), [name], ["entity_key", "period_key"]))
query("measures_by_period", f"select period_key, {dec('sum(revenue)')} revenue, {dec(f'sum({_EB})')} ebitda, {sql_ratio(f'sum({_EB})', 'sum(revenue)', 6)} ebitda_margin_pct, {dec('sum(total_current_assets + total_non_current_assets)')} total_assets from t_meas0 group by all")(
    lambda b: M.evaluate(measure_rows(b), ["revenue", "ebitda", "ebitda_margin_pct", "total_assets"], ["period_key"]))

# ---- alerts ---------------------------------------------------------------------------------------------------
KPIS = A.KPIS
kpi_wide = lambda b: A.kpi_wide(b.components, b.liquidity, b.cash_kpis)
kpi_long = lambda b: A.kpi_long(b.components, b.liquidity, b.cash_kpis)
TABLES["kpiw"] = """select c.period_key, c.entity_key, ebitda_margin_ratio, revenue_variance_ratio revenue_vs_budget_ratio, revenue_yoy_ratio, ebitda_variance_ratio ebitda_vs_budget_ratio, revenue, ebitda, revenue_budget, ebitda_budget, revenue_py, ebitda_py,
 cash cash_balance, dso_days, net_debt_ebitda, cash_runway_months * 30 cash_runway_days from t_comp c left join (select period_key pk, entity_key ek, cash, dso_days, net_debt_ebitda from t_liq where consolidation_scope = 'entity') l on pk = c.period_key and ek = c.entity_key
 left join (select period_key pk2, entity_key ek2, cash_runway_months from t_ck where consolidation_scope = 'entity') k on pk2 = c.period_key and ek2 = c.entity_key"""
TABLES["kpil"] = " union all ".join(
    f"select entity_key, period_key, '{k}' kpi_name, cast({k} as double) \"value\", {f'cast({k}_budget as double)' if k in ('revenue', 'ebitda') else 'null::double'} budget_value, {f'cast({k}_py as double)' if k in ('revenue', 'ebitda') else 'null::double'} py_value from kpiw where {k} is not null" for k in KPIS)
TABLES["rules_"] = _values(K.ALERT_RULES + K.LOCAL_RULES, K.RULE_COLUMNS)
TABLES["alert_"] = """select * from (select rule_code, k.entity_key, period_key, k.kpi_name, "value", operator, case threshold_unit when 'PCT_OF_BUDGET' then threshold_value * budget_value when 'PCT_OF_PY' then threshold_value * py_value else threshold_value end threshold, threshold_unit, severity, cooldown_hours
 from kpil k join rules_ r on r.kpi_name = k.kpi_name join ents e on e.entity_key = k.entity_key and (entity_scope = 'ALL' or entity_scope = entity_code)) where case operator when '<' then "value" < threshold when '>' then "value" > threshold when '<=' then "value" <= threshold when '>=' then "value" >= threshold else "value" = threshold end"""


rules = lambda b: b.values(K.ALERT_RULES + K.LOCAL_RULES, K.RULE_COLUMNS)
alerts = lambda b: b.stored("alerts", lambda: A.evaluate(kpi_long(b), rules(b), b.entities))
logged = lambda b: alerts(b).withColumn("status", F.when((F.col("period_key") + F.col("entity_key")) % 3 == 0, "CLOSED").when((F.col("period_key") + F.col("entity_key")) % 3 == 1, "ACKNOWLEDGED").otherwise("OPEN"))
TABLES["alog"] = "select *, case (period_key + entity_key) % 3 when 0 then 'CLOSED' when 1 then 'ACKNOWLEDGED' else 'OPEN' end status from alert_"
query("kpi_unpivot", 'select entity_key, period_key, kpi_name, "value" from kpil')(lambda b: A.kpi_unpivot(kpi_wide(b), KPIS))
query("alert_evaluate", "select * from alert_")(lambda b: A.evaluate(kpi_long(b), rules(b), b.entities))
query("alert_threshold_units", "select rule_code, entity_key, period_key, round(threshold * (1 + 1e-12), 4) threshold from alert_ where threshold_unit <> 'ABSOLUTE'")(
    lambda b: alerts(b).where("threshold_unit <> 'ABSOLUTE'").select("rule_code", "entity_key", "period_key", F.round(F.col("threshold") * (1 + 1e-12), 4).alias("threshold")))
query("rule_entity_cross", "select rule_code, entity_key, entity_code, severity from rules_ r join ents e on entity_scope = 'ALL' or entity_scope = entity_code")(
    lambda b: A.rules_by_entity(rules(b), b.entities).select("rule_code", "entity_key", "entity_code", "severity"))
query("orphan_rule_scopes", "select rule_code, entity_scope from rules_ where entity_scope <> 'ALL' and entity_scope not in (select entity_code from ents)")(
    lambda b: A.orphan_scopes(rules(b), b.entities).select("rule_code", "entity_scope"))
query("alert_unmatched_rules", "select rule_code, kpi_name from rules_ where kpi_name not in (select kpi_name from kpil)")(
    lambda b: A.unmatched_rules(rules(b), kpi_long(b)).select("rule_code", "kpi_name"))
CHECKED = "2001-05-31"


def alert_log(b):
    """Evaluated at the end of a month; some alerts are acknowledged or closed; evaluated again 30 hours later with the next month's figures, twice."""
    at = F.to_timestamp(F.lit(CHECKED))
    of = lambda period: kpi_long(b).where(F.col("period_key") == period)
    log = cut_lineage(A.evaluate_into(None, of(200105), rules(b), b.entities, at), "alert-log")
    changes = log.where("entity_key % 3 < 2").select("alert_id", F.when(F.col("entity_key") % 3 == 0, A.CLOSED).otherwise(A.ACKNOWLEDGED).alias("status"), at.alias("at"))
    log = cut_lineage(A.advance(log, changes), "alert-log")
    for _ in range(2):
        log = cut_lineage(A.evaluate_into(log, of(200106), rules(b), b.entities, at + F.make_dt_interval(hours=F.lit(30))), "alert-log")
    return log.select("rule_code", "entity_code", "period_key", "status", "severity", F.to_date("raised_at").alias("raised_on"), F.hour("raised_at").alias("raised_hour"),
                      F.col("acknowledged_at").isNotNull().alias("was_acknowledged"), F.col("closed_at").isNotNull().alias("was_closed"))


query("alert_log", f"""with f as (select rule_code, entity_code, period_key, case a.entity_key % 3 when 0 then 'CLOSED' when 1 then 'ACKNOWLEDGED' else 'OPEN' end status, severity, cooldown_hours, a.entity_key % 3 m
  from alert_ a join ents e on e.entity_key = a.entity_key where period_key = 200105)
 select rule_code, entity_code, period_key, status, severity, date '{CHECKED}' raised_on, 0 raised_hour, m = 1 was_acknowledged, m = 0 was_closed from f
 union all select rule_code, entity_code, period_key, 'OPEN', severity, date '{CHECKED}' + 1, 6, false, false from alert_ a join ents e on e.entity_key = a.entity_key
 where period_key = 200106 and not exists (select 1 from f where f.rule_code = a.rule_code and f.entity_code = e.entity_code and f.status <> 'CLOSED' and f.cooldown_hours > 30)""")(alert_log)
SEV = "case severity when 'CRITICAL' then 1 when 'HIGH' then 2 when 'MEDIUM' then 3 when 'LOW' then 4 when 'INFO' then 5 else 6 end"
query("alert_summary", f"select entity_key, severity, count(*) open_alerts, min(period_key) oldest_period, {SEV} severity_order from alog where status = 'OPEN' group by all")(lambda b: A.summary(logged(b)))
query("severity_order", f"select rule_code, severity, {SEV} severity_order, period_key, entity_key from alog where status = 'OPEN'")(
    lambda b: logged(b).where("status = 'OPEN'").select("rule_code", "severity", A.severity_rank().alias("severity_order"), "period_key", "entity_key").orderBy(
        "severity_order", "period_key", "entity_key", "rule_code"))
query("m_open_critical_alerts", "select entity_key, count(*) open_critical_alerts from alog where status = 'OPEN' and severity = 'CRITICAL' group by all")(
    lambda b: logged(b).where("status = 'OPEN' AND severity = 'CRITICAL'").groupBy("entity_key").agg(F.count("*").alias("open_critical_alerts")))
TABLES["lp"] = "select orderkey, seller_code entity_code, rule_code, posting_date + to_hours(cast(partkey % 24 as integer)) raised_at, cooldown_hours, case orderkey % 3 when 0 then 'OPEN' when 1 then 'ACKNOWLEDGED' else 'CLOSED' end status from base_lines join rules_ on rule_code = 'LARGE_SALE_LINE' and a_sale > threshold_value"


def large_postings(b):
    """Candidates of one rule, whose row gives the threshold and the cooldown."""
    ok, rule = F.col("orderkey"), K.rule("LARGE_SALE_LINE")
    return b.base().where(F.col("a_sale") > rule["threshold_value"]).select(
        "orderkey", F.col("seller_code").alias("entity_code"), F.lit(rule["rule_code"]).alias("rule_code"),
        (F.col("posting_date").cast("timestamp") + F.make_dt_interval(hours=(F.col("partkey") % 24).cast("int"))).alias("raised_at"),
        F.lit(rule["cooldown_hours"]).alias("cooldown_hours"),
        F.when(ok % 3 == 0, "OPEN").when(ok % 3 == 1, "ACKNOWLEDGED").otherwise("CLOSED").alias("status"))


query("alert_cooldown", """select entity_code, rule_code, cast(raised_at as date) raised_on, count(*) n from lp c where orderkey % 2 = 0 and not exists (select 1 from lp l where l.orderkey % 2 = 1 and l.status <> 'CLOSED' and l.entity_code = c.entity_code and l.rule_code = c.rule_code
 and l.raised_at <= c.raised_at and c.raised_at < l.raised_at + to_hours(l.cooldown_hours)) group by all""")(
    lambda b: A.after_cooldown(large_postings(b).where("orderkey % 2 = 0"), large_postings(b).where("orderkey % 2 = 1")).groupBy("entity_code", "rule_code", F.to_date("raised_at").alias("raised_on")).agg(n()))

# ---- versioned mapping ----------------------------------------------------------------------------------------
TABLES["cm1"] = "select e.entity_code company, c.* from (select distinct entity_key, account_code from tb) t join ents e on e.entity_key = t.entity_key join coa c on c.account_code = t.account_code"
TABLES["cm2"] = "select e.entity_code company, c.* from (select distinct entity_key, account_code from tb union select distinct entity_key, '59' from tb) t join ents e on e.entity_key = t.entity_key join coa2 c on c.account_code = t.account_code"
_HASH = "sha256(" + " || '|' || ".join(f"coalesce(cast({c} as varchar), '')" for c in H.TRACKED) + ")"
TABLES["scd"] = f"""with o as (select *, {_HASH} h from cm1), v as (select *, {_HASH} h from cm2)
 select o.* exclude (h), o.h row_digest, date '1995-01-01' valid_from, case when v.h = o.h then null else date '2000-01-01' end valid_to, coalesce(v.h = o.h, false) is_current from o left join v on v.company = o.company and v.account_code = o.account_code
 union all select v.* exclude (h), v.h, date '2000-01-01', null, true from v left join o on v.company = o.company and v.account_code = o.account_code where o.h is null or o.h <> v.h"""
company_accounts = lambda b: b.trial_balance.select("entity_key", "account_code").distinct().join(b.entities.select("entity_key", F.col("entity_code").alias("company")), "entity_key")


def snapshot(b):
    first = company_accounts(b).join(b.accounts, "account_code").select("company", *K.ACCOUNT_COLUMNS)
    second = company_accounts(b).select("company", "account_code").unionByName(company_accounts(b).select("company", F.lit("59").alias("account_code"))).distinct().join(
        b.values(K.ACCOUNTS_V2, K.ACCOUNT_COLUMNS), "account_code").select("company", *K.ACCOUNT_COLUMNS)
    return H.scd2_apply(H.scd2_first(first, H.TRACKED, "1995-01-01"), second, ["company", "account_code"], H.TRACKED, "2000-01-01")


query("scd2_snapshot", "select * from scd")(snapshot)
query("temporal_mapping_join", f"""select g.entity_code, g.account_code, l1_category, account_name, count(*) n, {dec('sum(net)')} net from gl g join scd s on s.company = g.entity_code and s.account_code = g.account_code
 and posting_date >= valid_from and (valid_to is null or posting_date < valid_to) group by all""")(
    # a version is valid for all postings of a company, account and day, so these are added up before they meet it
    lambda b: H.valid_at(b.ledger().groupBy(F.col("entity_code").alias("company"), "account_code", "posting_date").agg(n(), *summed("net")),
                         snapshot(b), ["company", "account_code"], "posting_date", ["l1_category", "account_name"]).withColumnRenamed("company", "entity_code")
    .groupBy("entity_code", "account_code", "l1_category", "account_name").agg(F.sum("n").alias("n"), *summed("net")))
TABLES["gov"] = """select *, case (length(company) + length(universal_node) + version) % 10 when 8 then 'PENDING' when 9 then 'DISPUTED' else 'APPROVED' end review_status, case when (length(universal_node) + version) % 5 = 0 then date '2001-06-30' end valid_to
 from (select *, unnest([1, 2]) version from cm1)"""


def governed(b):
    """Two governance versions of each company account with review status and validity."""
    rows = company_accounts(b).join(b.accounts, "account_code").select("company", *K.ACCOUNT_COLUMNS, F.explode(F.array(F.lit(1), F.lit(2))).alias("version"))
    state = (F.length("company") + F.length("universal_node") + F.col("version")) % 10
    return rows.withColumns({"review_status": F.when(state == 8, "PENDING").when(state == 9, "DISPUTED").otherwise("APPROVED"),
                             "valid_to": F.when((F.length("universal_node") + F.col("version")) % 5 == 0, F.to_date(F.lit("2001-06-30")))})


def account_master(b):
    from ..operators.windows import latest_per_key
    live = governed(b).where("review_status = 'APPROVED'").where(F.col("valid_to").isNull() | (F.col("valid_to") > F.to_date(F.lit(K.AS_OF))))
    return latest_per_key(live, ["company", "account_code"], ["version"]).select("company", "account_code", "version", "universal_node", "account_type")


query("account_master", "select company, account_code, version, universal_node, account_type from (select *, row_number() over (partition by company, account_code order by version desc) rn from gov where review_status = 'APPROVED' and (valid_to is null or valid_to > date '2001-12-31')) where rn = 1")(account_master)
query("mapping_coverage", f"""select company, count(*) total, count(case when review_status = 'APPROVED' then 1 end) approved, count(case when review_status = 'PENDING' then 1 end) pending, count(case when review_status = 'DISPUTED' then 1 end) disputed,
 {sql_ratio("count(case when review_status = 'APPROVED' then 1 end)", 'count(*)', 1, 100)} approved_pct, count(case when valid_to is null or valid_to > date '2001-12-31' then 1 end) currently_valid from gov group by all""")(
    lambda b: governed(b).groupBy("company").agg(
        F.count("*").alias("total"), *[F.count(F.when(F.col("review_status") == s.upper(), 1)).alias(s) for s in ("approved", "pending", "disputed")],
        F.count(F.when(F.col("valid_to").isNull() | (F.col("valid_to") > F.to_date(F.lit(K.AS_OF))), 1)).alias("currently_valid")).withColumn(
        "approved_pct", F.round(F.col("approved").cast("double") / F.col("total") * 100 * (1 + 1e-12), 1)))

# ---- restatement, late entries --------------------------------------------------------------------------------
LATE = "posting_date <= last_day(posting_date) and ingestion_date > last_day(posting_date) + 5"
RK = ["entity_key", "period_key", "account_code"]
query("restatement_log", f"""select *, restated_amount - original_amount delta, {sql_ratio('(restated_amount - original_amount)', 'abs(original_amount)', 4, 100)} delta_pct from (
 select entity_key, period_key, account_code, {dec(f'sum(case when {LATE} then 0 else net end)')} original_amount, {dec('sum(net)')} restated_amount, count(case when {LATE} then 1 end) late_entries from gl group by all) where late_entries > 0""")(
    lambda b: H.restatement(b.ledger(), RK, dq.is_late()))
query("restatement_late_ids", f"""with l as (select *, count(*) over (partition by entity_key, period_key, account_code) c from gl where {LATE}),
 k as (select *, cast('0x' || substr(md5(transaction_id), 1, 8) as bigint) % cast(ceil(c / 20.0) as bigint) chunk_no from l)
 select entity_key, period_key, account_code, chunk_no, count(*) ids, md5(string_agg(transaction_id, ',' order by transaction_id)) digest from k group by all""")(
    lambda b: H.late_id_chunks(b.ledger(), RK, dq.is_late(), size=20).select(*RK, "chunk_no", F.size("late_ids").cast("long").alias("ids"), F.md5(F.array_join("late_ids", ",")).alias("digest")))
query("late_entry_materiality", f"""select *, {sql_ratio('late_revenue', 'revenue', 6)} revenue_share, {sql_ratio('late_opex', 'opex', 6)} opex_share, coalesce({sql_ratio('late_revenue', 'revenue', 6)} > 0.005, false) or coalesce({sql_ratio('late_opex', 'opex', 6)} > 0.02, false) is_material from (
 select entity_key, period_key, {dec("sum(case when l1_category = 'Revenue' then -net else 0 end)")} revenue, {dec("sum(case when l1_category = 'OPEX' then net else 0 end)")} opex,
 {dec(f"sum(case when l1_category = 'Revenue' and {LATE} then abs(net) end)")} late_revenue, {dec(f"sum(case when l1_category = 'OPEX' and {LATE} then abs(net) end)")} late_opex from gl g join coa c on c.account_code = g.account_code group by all)""")(
    lambda b: H.late_materiality(b.ledger(), b.accounts, dq.is_late()))

# ---- budget versions, batches ---------------------------------------------------------------------------------
VNO = {"ORIGINAL_BUDGET": 1, "REVISED_BUDGET": 2, "ROLLING_FORECAST": 3}
version_no = reduce(lambda a, kv: f"{a} when '{kv[0]}' then {kv[1]}", VNO.items(), "case budget_version") + " end"


def active_version(b):
    number = F.create_map(*[F.lit(x) for kv in VNO.items() for x in kv])[F.col("budget_version")]
    versions = b.budget.select("entity_key", F.col("period_year").alias("fiscal_year"), "budget_version").distinct().withColumn("version_no", number).withColumn(
        "approved", (F.col("entity_key") + F.col("fiscal_year") + F.col("version_no")) % 4 != 0)
    return H.active_budget(versions)


query("active_budget_version", f"""with v as (select distinct entity_key, period_key // 100 fiscal_year, budget_version, {version_no} version_no from bud),
 a as (select entity_key, fiscal_year, max_by(budget_version, version_no) budget_version from v where (entity_key + fiscal_year + version_no) % 4 <> 0 group by all)
 select a.entity_key, cast(a.fiscal_year as integer) fiscal_year, a.budget_version, {dec('sum(budget_amount)')} budget_amount, count(*) n from a join bud b on b.entity_key = a.entity_key and b.period_key // 100 = a.fiscal_year and b.budget_version = a.budget_version group by all""")(
    lambda b: b.budget.withColumn("fiscal_year", F.col("period_year")).join(active_version(b), ["entity_key", "fiscal_year", "budget_version"]).groupBy("entity_key", "fiscal_year", "budget_version").agg(*summed("budget_amount"), n()))


def batch_log(b):
    """Row counts per stage observed while the staged ledger is written; one log row, no second pass over the data."""
    raw, staged = Observation("bronze"), Observation("staged")
    bronze = staging.bronze_ledger(b.ledger(on_lines=staging.line_texts)).observe(raw, F.count("*").alias("rows"))
    out = staging.stage_gl(bronze, b.accounts).observe(staged, F.count("*").alias("rows"), F.count(F.when(F.col("is_unmapped_account"), 1)).alias("unmapped"))
    out.write.option("compression", "zstd").parquet(fresh_path(b.spark, "staged-ledger"))
    got, kept = raw.get, staged.get
    return b.values([("CLOSE", K.AS_OF_PERIOD, got["rows"], kept["rows"], got["rows"] - kept["rows"], kept["unmapped"], "COMPLETED")],
                    ["batch_type", "period_key", "bronze_rows", "staged_rows", "rejected_rows", "unmapped_rows", "status"]).select(
        "batch_type", "period_key", *[F.col(c).cast("long").alias(c) for c in ("bronze_rows", "staged_rows", "rejected_rows", "unmapped_rows")], "status")


query("batch_log", """select 'CLOSE' batch_type, 200112 period_key, count(*) bronze_rows, count(case when entity_code is not null and account_code is not null then 1 end) staged_rows, count(case when entity_code is null or account_code is null then 1 end) rejected_rows,
 count(case when entity_code is not null and account_code is not null and account_code not in (select account_code from coa) then 1 end) unmapped_rows, 'COMPLETED' status from bronze""")(batch_log)

# ---- review queue ---------------------------------------------------------------------------------------------
TABLES["cq"] = """select o_orderkey queue_id, cast(c_nationkey as integer) entity_key, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) period_key, o_orderpriority "role", o_orderstatus content,
 case o_orderkey % 4 when 0 then 'APPROVED' when 1 then 'REJECTED' else 'PENDING' end status from orders join customer on c_custkey = o_custkey"""


def review_queue(b):
    """Commentary drafts: one per order, keyed by company, month and role."""
    k = F.col("o_orderkey") % 4
    return b.t("orders").join(b.t("customer").select("c_custkey", "c_nationkey"), F.col("c_custkey") == F.col("o_custkey")).select(
        F.col("o_orderkey").alias("queue_id"), F.col("c_nationkey").cast("int").alias("entity_key"),
        (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("int").alias("period_key"), F.col("o_orderpriority").alias("role"), F.col("o_orderstatus").alias("content"),
        F.when(k == 0, "APPROVED").when(k == 1, "REJECTED").otherwise("PENDING").alias("status"))


def published(b):
    queue = review_queue(b)
    before = queue.where("status = 'APPROVED' AND queue_id % 8 = 0").select(F.col("queue_id").alias("source_queue_id"), "entity_key", "period_key", "role", "content")
    out, state = H.publish(queue, before)
    return state.groupBy("entity_key", "status").agg(n()).unionByName(out.groupBy("entity_key").agg(n()).select("entity_key", F.lit("IN_PUBLISHED_SET").alias("status"), "n"))


query("publish_approved", """select entity_key, case status when 'APPROVED' then 'PUBLISHED' else status end status, count(*) n from cq group by all union all select entity_key, 'IN_PUBLISHED_SET', count(*) from cq where status = 'APPROVED' group by all""")(published)
query("queue_supersede", """select queue_id, entity_key, period_key, "role", case when status = 'PENDING' and queue_id < max(case when status = 'PENDING' then queue_id end) over (partition by entity_key, period_key, "role") then 'SUPERSEDED' else status end status from cq""")(
    lambda b: H.supersede(review_queue(b), ["entity_key", "period_key", "role"]).select("queue_id", "entity_key", "period_key", "role", "status"))

# ---- fact pack ------------------------------------------------------------------------------------------------
_huf = lambda c: f"case when {c} is not null then printf('%.1fM HUF', round(cast({c} as double) / 1e6 * (1 + 1e-12), 1) + 0) end"
_pct = lambda c: f"case when {c} is not null then printf('%.1f%%', round({c} * (1 + 1e-12), 1) + 0) end"
_x = lambda c: f"case when {c} is not null then printf('%.2fx', round({c} * (1 + 1e-12), 2) + 0) end"
_day = lambda c: f"case when {c} is not null then printf('%.0f days', round({c} * (1 + 1e-12), 0) + 0) end"
_mask = lambda c: f"case when coalesce(abs({c}) >= 5, false) then {_pct(c)} else 'within materiality' end"
_al = lambda c, l: f"case when abs({c}) > 10 then {{'kpi': '{l}', 'value': {_pct(c)}, 'alert_tag': '[ALERT]', 'direction': case when {c} > 0 then 'above target' else 'below target' end}} end"
query("variance_fact_pack", f"""select p.period_key, p.entity_key, cast(to_json({{'report_metadata': {{'entity_code': entity_code, 'period': strftime(make_date(p.period_key // 100, p.period_key % 100, 1), '%B %Y'), 'period_key': p.period_key, 'reporting_currency': 'HUF'}},
 'pl_summary': {{'revenue': {_huf('revenue')}, 'revenue_budget': {_huf('revenue_budget')}, 'revenue_vs_budget_pct': {_mask('revenue_variance_pct')}, 'revenue_vs_py_pct': {_mask('revenue_yoy_pct')}, 'gross_margin_pct': {_pct('gross_margin_pct')},
  'ebitda': {_huf('ebitda')}, 'ebitda_margin_pct': {_pct('ebitda_margin_pct')}, 'net_profit': {_huf('net_profit')}, 'net_profit_margin_pct': {_pct('net_profit_margin_pct')}}},
 'balance_sheet_highlights': {{'total_assets': {_huf('l.total_assets')}, 'total_equity': {_huf('l.total_equity')}, 'net_debt': {_huf('l.net_debt')}, 'equity_ratio_pct': {_pct('equity_ratio_pct')}, 'net_debt_to_ebitda': {_x('net_debt_ebitda')}}},
 'liquidity_highlights': {{'current_ratio': {_x('current_ratio')}, 'dso_days': {_day('dso_days')}, 'dpo_days': {_day('dpo_days')}, 'cash_conversion_cycle_days': {_day('cash_conversion_cycle_days')}}},
 'cash_flow': {{'operating_cash_flow': {_huf('c.operating_cash_flow')}, 'free_cash_flow': {_huf('c.free_cash_flow')}, 'cash_and_equivalents': {_huf('c.cash_and_equivalents')}}},
 'alerts': list_filter([{_al('revenue_variance_pct', 'Revenue vs Budget')}, {_al('revenue_yoy_pct', 'Revenue vs Prior Year')}], lambda a: a is not null)}}) as varchar) fact_pack
 from t_prof p join t_liq l on l.period_key = p.period_key and l.entity_key = p.entity_key and l.consolidation_scope = 'entity' join t_ck c on c.period_key = p.period_key and c.entity_key = p.entity_key and c.consolidation_scope = 'entity'
 join ents e on e.entity_key = p.entity_key where p.consolidation_scope = 'entity'""")(lambda b: R.as_json(R.fact_pack(b.profitability, b.liquidity, b.cash_kpis, b.entities)))


DROPPED, THINNED = 200103, 200104


def monthly_close(b):
    """Two closes into one target. The second delivery has a month more, lacks one that the first had, and has rows that one batch of the first
    lacked; the result shows what the tables hold then."""
    from ..plans.close import run_close
    target = fresh_path(b.spark, "monthly-close")
    run_close(b.spark, b.dir, 200105, target, b.ledger().where(f"NOT (period_key = {THINNED} AND partkey % 10 = 0)"))
    result = run_close(b.spark, b.dir, 200106, target, b.ledger().where(f"period_key <> {DROPPED}"))
    read = lambda name: b.spark.read.parquet(result.tables[name]).withColumn("period_key", F.col("period_key").cast("int"))
    parts = [read(name).groupBy("period_key").agg(n(), F.sum(F.col("debit").cast("decimal(38,2)")).alias("debit")).where("period_key >= 200101") for name in ("fact", "quarantine")]
    nothing = F.lit(None).cast("decimal(38,2)").alias("debit")
    parts += [read(name).where("period_key = 200106").groupBy("period_key").agg(n()).select("period_key", "n", nothing) for name in ("pl_monthly", "balance_sheet", "cashflow")]
    parts = [p.select(F.lit(name).alias("table_name"), "period_key", "n", "debit") for name, p in zip(("fact", "quarantine", "pl_monthly", "balance_sheet", "cashflow"), parts)]
    return reduce(lambda x, y: x.unionByName(y), parts).withColumns({"status": F.lit(result.status), "changed_batches": F.lit(result.changed_batches)})


query("monthly_close", f"""with e as (select *, bool_or(account_code not in (select account_code from coa)) over (partition by source_id, partkey, entity_key, leg, transaction_id[:-2]) bad from gl where period_key between 200101 and 200106 and period_key <> {DROPPED})
 select *, 'COMPLETED' status, (select cast(count(distinct batch_id) as integer) from gl where period_key in (200106, {DROPPED}) or (period_key = {THINNED} and partkey % 10 = 0)) changed_batches from (
 select 'fact' table_name, period_key, count(*) n, {dec('sum(debit)')} debit from e where not bad group by all union all select 'quarantine', period_key, count(*), {dec('sum(debit)')} from e where bad group by all
 union all select 'pl_monthly', period_key, count(*), null from t_pl where period_key = 200106 group by all union all select 'balance_sheet', period_key, count(*), null from bs_nodes where period_key = 200106 group by all
 union all select 'cashflow', period_key, count(*), null from t_cf where period_key = 200106 group by all)""")(monthly_close)
