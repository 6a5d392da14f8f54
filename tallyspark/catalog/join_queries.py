"""Mapping, currency, intercompany, dimension and access joins; orders, limits and set operations."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.money import rnd
from ..operators import access, accounts as acc, dims, fx, intercompany as ic
from ..operators.statements import KEY
from ..plans import constants as K
from ..plans.books import Books
from .oracle_tables import TABLES, crossed, dec, over, times
from .registry import query

n = lambda: F.count("*").alias("n")  # built when a query runs: the registry loads without a session
summed = lambda *cols: [F.sum(c).alias(c) for c in cols]

TABLES["fxday"] = """select currency_code, cast(unnest(generate_series(rate_date, last_day_, interval 1 day)) as date) "day", rate_date, rate_to_huf from (
 select *, coalesce(cast(lead(rate_date) over (partition by currency_code order by rate_date) - 1 as date), greatest(date '2001-12-31', rate_date)) last_day_ from rates)"""
TABLES["fxlast"] = "select currency_code, max_by(rate_to_huf, rate_date) latest_rate from rates group by 1"

query("map_accounts", f"""select entity_key, g.account_code, universal_node, pl_line_item, count(*) n, {dec("sum(case when account_type = 'Revenue' then -net else net end)")} signed from gl g join coa c on g.account_code = c.account_code group by all""")(
    lambda b: acc.map_accounts(b.ledger(), b.accounts).groupBy("entity_key", "account_code", "universal_node", "pl_line_item").agg(n(), *summed("signed")))


def company_mapping(b: Books):
    """Default rows for every company, overridden by one company per group for account 58."""
    default = b.accounts.select(F.lit("DEFAULT").alias("company"), "account_code", "l1_category")
    own = b.entities.where("parent_key IS NULL").select(F.col("entity_code").alias("company"), F.lit("58").alias("account_code"), F.lit("COGS").alias("l1_category"))
    return default.unionByName(own)


query("map_accounts_default", f"""select g.entity_code, g.account_code, case when account_code_ = '58' and parent_key is null then 'COGS' else l1_category end l1_category,
 case when account_code_ = '58' and parent_key is null then 'ENTITY' when l1_category is not null then 'DEFAULT' end mapping_source, count(*) n, {dec('sum(net)')} net
 from (select *, account_code account_code_ from gl) g join ents e on e.entity_code = g.entity_code left join (select account_code, l1_category from coa) c on c.account_code = g.account_code group by all""")(
    lambda b: acc.map_accounts_default(b.ledger(), company_mapping(b), ["l1_category"]).groupBy("entity_code", "account_code", "l1_category", "mapping_source").agg(n(), *summed("net")))
query("quarantine_unmapped", "select transaction_id, entity_code, account_code, posting_date, net, 'UNMAPPED_ACCOUNT_CODE' quarantine_reason from gl where account_code not in (select account_code from coa)")(
    lambda b: acc.quarantine_unmapped(b.ledger(), b.accounts).select("transaction_id", "entity_code", "account_code", "posting_date", "net", "quarantine_reason"))

# ---- exchange rates -------------------------------------------------------------------------------------------
query("fx_exact_date", f"""select currency_code, period_key, count(*) n, {dec('sum(net_eur)')} net_eur, {dec('sum(adj)')} net_lcy_fx_adjusted, count(case when fe then 1 end) eur_fallbacks, count(case when ff then 1 end) fcy_fallbacks from (
 select g.currency_code, period_key, {over('net', 'coalesce(e.rate_to_huf, 400)')} net_eur, e.rate_date is null fe, g.currency_code <> 'HUF' and f.rate_date is null ff,
 case when g.currency_code = 'HUF' then net else {times('(debit_fcy - credit_fcy)', 'coalesce(f.rate_to_huf, 1)')} end adj
 from gl g left join rates e on e.rate_date = posting_date and e.currency_code = 'EUR' left join rates f on f.rate_date = posting_date and f.currency_code = g.currency_code) group by all""")(
    lambda b: fx.convert_exact_date(b.ledger(), b.fx_rates).groupBy("currency_code", "period_key").agg(
        n(), *summed("net_eur", "net_lcy_fx_adjusted"), F.count(F.when(F.col("used_fallback_eur_rate"), 1)).alias("eur_fallbacks"),
        F.count(F.when(F.col("used_fallback_fcy_rate"), 1)).alias("fcy_fallbacks")))
events_by_day = lambda b: b.base().select("posting_date", "buyer_region", "a_sale").join(
    b.currencies.select(F.col("region_key").alias("buyer_region"), "currency_code"), "buyer_region").where("currency_code <> 'HUF'")
query("fx_asof", f"""select s.currency_code, posting_date, coalesce(d.rate_to_huf, l.latest_rate) rate_to_huf, count(*) n, {dec('sum(a_sale)')} amount from (
  select currency_code, posting_date, a_sale from base_lines join ccy on region_key = buyer_region where currency_code <> 'HUF') s
 asof left join rates d on d.currency_code = s.currency_code and s.posting_date >= d.rate_date left join fxlast l on l.currency_code = s.currency_code group by all""")(
    lambda b: fx.attach_asof(events_by_day(b), b.fx_daily, b.fx_rates, "posting_date", "currency_code").groupBy("currency_code", "posting_date", "rate_to_huf").agg(
        n(), F.sum("a_sale").alias("amount")))
query("fx_fcy_to_huf", f"""select currency_code, period_key, {dec('sum(huf)')} amount_huf, count(*) n from (select g.currency_code, period_key,
 case when g.currency_code = 'HUF' then debit_fcy else {times('debit_fcy', 'coalesce(d.rate_to_huf, 1)')} end huf from gl g left join fxday d on d.currency_code = g.currency_code and d."day" = posting_date) group by all""")(
    lambda b: fx.fcy_to_huf(b.ledger(), b.fx_daily, "debit_fcy").groupBy("currency_code", "period_key").agg(*summed("amount_huf"), n()))
query("fx_period_end", """select p.period_key, c.currency_code, last_day(make_date(p.period_key // 100, p.period_key % 100, 1)) period_end, coalesce(d.rate_to_huf, l.latest_rate) rate_to_huf
 from (select distinct period_key from tb) p cross join (select distinct currency_code from rates) c left join fxlast l on l.currency_code = c.currency_code
 left join fxday d on d.currency_code = c.currency_code and d."day" = last_day(make_date(p.period_key // 100, p.period_key % 100, 1))""")(
    lambda b: fx.period_end_rates(
        b.trial_balance.select("period_key").distinct().withColumn("currency_code", F.explode(F.array(*[F.lit(c[0]) for c in K.CURRENCIES if c[0] != "HUF"]))),
        b.fx_daily, b.fx_rates).select("period_key", "currency_code", "period_end", "rate_to_huf"))
_OWN = "case when g.currency_code = 'HUF' then 1 else o.rate_to_huf end"
_CROSS = "(case when g.currency_code = 'HUF' then 1.0::double else cast(o.rate_to_huf as double) end / cast(e.rate_to_huf as double))"
query("fx_cross_to_eur", f"""select g.currency_code, period_key, {dec(f"sum({crossed('debit_fcy', _OWN, 'e.rate_to_huf')})")} amount_eur, count(*) n, count({_CROSS}) rated from gl g left join fxday o on o.currency_code = g.currency_code and o."day" = posting_date
 left join (select * from fxday where currency_code = 'EUR') e on e."day" = posting_date group by all""")(
    lambda b: fx.cross_to_eur(b.ledger(), b.fx_daily, "debit_fcy").groupBy("currency_code", "period_key").agg(*summed("amount_eur"), n(), F.count("rate_to_eur").alias("rated")))
query("fx_availability_range", """select currency_code, posting_date, count(*) n from gl g where currency_code <> 'HUF' and not exists (select 1 from rates r where r.currency_code = g.currency_code
 and r.rate_date between g.posting_date - interval 3 day and g.posting_date + interval 1 day) group by all""")(
    lambda b: fx.without_rate(b.ledger(), b.fx_rates, 3, 1).groupBy("currency_code", "posting_date").agg(n()))

# ---- intercompany ---------------------------------------------------------------------------------------------
query("ic_flag_transactions", f"""with s as (select distinct seller_key entity_key, seller_account account_code, 'SELLER' ic_side, transaction_type from reg where is_active union select distinct buyer_key, buyer_account, 'BUYER', transaction_type from reg where is_active)
 select g.entity_key, g.account_code, ic_side is not null is_ic_transaction, ic_side, coalesce(transaction_type, 'NON_IC') ic_transaction_type, count(*) n, {dec('sum(net)')} net
 from gl g left join s on s.entity_key = g.entity_key and s.account_code = g.account_code group by all""")(
    lambda b: ic.flag_transactions(b.ledger(), b.registry).groupBy("entity_key", "account_code", "is_ic_transaction", "ic_side", "ic_transaction_type").agg(n(), *summed("net")))
query("ic_flag_effective_dated", f"""with s as (select seller_key e, seller_account a, buyer_key c, * from reg where is_active union all select buyer_key, buyer_account, seller_key, * from reg where is_active)
 select g.entity_key, g.counterparty_key, g.account_code, s.pair_id, s.pair_id is not null is_ic_effective, count(*) n, {dec('sum(net)')} net from gl g left join s on e = g.entity_key and a = g.account_code and c = g.counterparty_key
 and posting_date >= valid_from and (valid_to is null or posting_date <= valid_to) group by all""")(
    lambda b: ic.flag_effective_dated(b.ledger(), b.registry).groupBy("entity_key", "counterparty_key", "account_code", "pair_id", "is_ic_effective").agg(n(), *summed("net")))
query("ic_flag_consistency", f"""with s as (select seller_key e, seller_account a from reg where is_active union select buyer_key, buyer_account from reg where is_active)
 select entity_key, g.account_code, count(*) n, {dec('sum(net)')} net from gl g join coa on coa.account_code = g.account_code and is_ic_account where not exists (select 1 from s where e = entity_key and a = g.account_code) group by all""")(
    lambda b: ic.flag_mismatches(b.ledger(accounts=[a[0] for a in K.ACCOUNTS if a[-1]]), b.accounts, b.registry).groupBy("entity_key", "account_code").agg(n(), *summed("net")))
query("ic_participants", "select distinct * from (select seller_key entity_key, seller_account account_code from reg where is_active union select buyer_key, buyer_account from reg where is_active)")(
    lambda b: b.registry.where("is_active").select(F.col("seller_key").alias("entity_key"), F.col("seller_account").alias("account_code")).union(
        b.registry.where("is_active").select("buyer_key", "buyer_account")).distinct())
query("reversal_pairs", f"""with s as (select source_id, entity_key, seller_key, posting_date, debit, partkey, suppkey from (select *, cast(null as integer) entity_key from sale_rows)),
 r as (select source_id, count(*) postings, {dec('sum(debit)')} amount from s group by all), x as (select source_id, -debit amount from sale_rows where returnflag = 'R')
 select r.source_id, postings, amount, coalesce(reversed_amount, 0) reversed_amount, amount + coalesce(reversed_amount, 0) net_amount, amount + coalesce(reversed_amount, 0) = 0 fully_reversed
 from r join (select source_id, {dec('sum(amount)')} reversed_amount from x group by all) v on v.source_id = r.source_id""")(
    lambda b: reversal_pairs(b))


def reversal_pairs(b: Books):
    """Returned lines give a reversing posting that names the posting it cancels; both are matched by the source id."""
    s = b.base().select(F.concat_ws("-", "orderkey", "linenumber").alias("source_id"), "returnflag", "a_sale")
    reversal = F.when(F.col("returnflag") == "R", -F.col("a_sale"))
    matched = s.groupBy("source_id").agg(F.count("*").alias("postings"), F.sum("a_sale").alias("amount"), F.sum(reversal).alias("reversed_amount")).where("reversed_amount IS NOT NULL")
    net = F.col("amount") + F.col("reversed_amount")
    return matched.select("source_id", "postings", "amount", "reversed_amount", net.alias("net_amount"), (net == 0).alias("fully_reversed"))


# ---- dimensions -----------------------------------------------------------------------------------------------
def dim_of(frame, natural, key):
    return dims.issue_keys(None, frame.distinct(), natural, key)


def account_dim(b):
    """Loaded twice: the accounts with postings before April 1995 first, then all; the first load's keys stay."""
    rows = b.trial_balance.join(b.entities, "entity_key").join(b.accounts, "account_code")
    columns, natural = ["entity_code", "account_code", "universal_node", "account_type"], ["entity_code", "account_code"]
    first = dims.issue_keys(None, rows.where("period_key < 199504").select(*columns).distinct(), natural, "account_key")
    return dims.issue_keys(first, rows.select(*columns).distinct(), natural, "account_key")


entity_dim = lambda b: dim_of(b.entities.select("entity_code", "consolidation_group", "method"), ["entity_code"], "entity_sk")
centre_dim = lambda b: dim_of(b.t("part").select(F.col("p_type").alias("cost_centre")), ["cost_centre"], "cost_centre_key")
project_dim = lambda b: dim_of(b.t("part").select(F.col("p_brand").alias("project")), ["project"], "project_key")
currency_dim = lambda b: dim_of(b.fx_rates.select("currency_code"), ["currency_code"], "currency_key")
TABLES["d_entity"] = "select entity_code, consolidation_group, method, row_number() over (order by md5(entity_code)) entity_sk from ents"
TABLES["d_account"] = """select entity_code, account_code, universal_node, account_type, row_number() over (order by first_period >= 199504, md5(entity_code || '|' || account_code)) account_key from (
 select entity_code, t.account_code, universal_node, account_type, min(period_key) first_period from tb t join ents e on e.entity_key = t.entity_key join coa c on c.account_code = t.account_code group by all)"""
for _n, _c, _col in (("d_centre", "cost_centre", "p_type"), ("d_project", "project", "p_brand")):
    TABLES[_n] = f"select *, row_number() over (order by md5({_c})) {_c}_key from (select distinct {_col} {_c} from part)"
TABLES["d_currency"] = "select *, row_number() over (order by md5(currency_code)) currency_key from (select distinct currency_code from rates)"
query("dim_entity", "select * from d_entity")(entity_dim)
query("dim_account", "select * from d_account")(account_dim)
query("dim_cost_centre", "select * from d_centre")(centre_dim)
query("dim_project", "select * from d_project")(project_dim)
query("dim_currency", "select * from d_currency")(currency_dim)


def star(b: Books):
    """Postings with the keys of their dimensions. All postings of an order line share its centre, project, currency and date, so these are
    looked up for the line, and only company and account for the posting."""
    def of_line(lines):
        lines = dims.resolve(lines, centre_dim(b), {"cost_centre": "cost_centre"}, "cost_centre_key")
        lines = dims.resolve(lines, project_dim(b), {"project": "project"}, "project_key")
        lines = dims.resolve(lines, currency_dim(b), {"currency_code": "currency_code"}, "currency_key")
        return lines.withColumn("date_key", F.date_format("posting_date", "yyyyMMdd").cast("int"))

    fact = b.ledger(dims=True, on_lines=of_line)
    fact = dims.resolve(fact, entity_dim(b), {"entity_code": "entity_code"}, "entity_sk")
    return dims.resolve(fact, account_dim(b), {"entity_code": "entity_code", "account_code": "account_code"}, "account_key")


query("resolve_dimensions", f"""select entity_sk, coalesce(account_key, -1) account_key, coalesce(cost_centre_key, -1) cost_centre_key, coalesce(project_key, -1) project_key, coalesce(currency_key, -1) currency_key,
 count(*) n, {dec('sum(net)')} net, cast(min(strftime(posting_date, '%Y%m%d')) as integer) first_date_key from gl g left join d_entity e on e.entity_code = g.entity_code left join d_account a on a.entity_code = g.entity_code and a.account_code = g.account_code
 left join d_centre cc on cc.cost_centre = g.cost_centre left join d_project p on p.project = g.project left join d_currency cu on cu.currency_code = g.currency_code group by all""")(
    lambda b: star(b).groupBy("entity_sk", "account_key", "cost_centre_key", "project_key", "currency_key").agg(n(), *summed("net"), F.min("date_key").alias("first_date_key")))
order_days = lambda b: dims.calendar_of(b.t("orders").select(F.to_date("o_orderdate").alias("d")), "d")
# movable days by the rule for 1900 to 2099
_GD = "((19 * (year(d) % 19) + 24) % 30)"
_GE = f"((2 * (year(d) % 4) + 4 * (year(d) % 7) + 6 * {_GD} + 5) % 7)"
_EASTER = f"make_date(year(d), 3, 22) + cast({_GD} + {_GE} - case when {_GD} + {_GE} = 35 or ({_GD} = 28 and {_GE} = 6 and year(d) % 19 > 10) then 7 else 0 end as integer)"
HOL = " or ".join([f"(month(d) = {m} and day(d) = {x})" for m, x in K.FIXED_HOLIDAYS] + [f"d = {_EASTER} + {n_}" for n_ in K.DAYS_AFTER_EASTER])
TABLES["cal"] = f"""select *, sum(tr) over (partition by period_key order by d rows unbounded preceding) tn, sum(tr) over (partition by period_key) tm from (
 select d, cast(year(d) * 100 + month(d) as integer) period_key, {HOL} hol, case when isodow(d) < 6 and not ({HOL}) then 1 else 0 end tr from (
 select cast(unnest(generate_series(make_date(year(min(o_orderdate)), 1, 1), make_date(year(max(o_orderdate)), 12, 31), interval 1 day)) as date) d from orders))"""
query("trading_days", "select d full_date, period_key, tr = 1 is_trading_day, cast(tn as integer) trading_day_number, cast(tm as integer) trading_days_in_month from cal")(
    lambda b: dims.with_trading_days(order_days(b)))
HU = "['" + "','".join(dims.HUNGARIAN_MONTHS) + "']"
query("dim_date", f"""select cast(strftime(d, '%Y%m%d') as integer) date_key, d full_date, cast(year(d) as integer) calendar_year, cast(quarter(d) as integer) calendar_quarter, cast(month(d) as integer) calendar_month, ({HU})[month(d)] month_name_hu,
 strftime(d, '%B') month_name_en, cast(weekofyear(d) as integer) iso_week, cast(isodow(d) as integer) iso_weekday, d = last_day(d) is_month_end, month(d) = 12 and day(d) = 31 is_year_end, cast(year(d) as integer) fiscal_year, cast(month(d) as integer) fiscal_period,
 cast(quarter(d) as integer) fiscal_quarter, period_key, case when period_key % 100 = 1 then period_key - 89 else period_key - 1 end prior_period_key, period_key - 100 prior_year_period_key, hol is_holiday, tr = 1 is_trading_day,
 cast(tn as integer) trading_day_number, cast(tm as integer) trading_days_in_month from cal""")(lambda b: dims.dim_date(order_days(b)))
query("budget_daily_interpolation", f"""select b.entity_key, d full_date, count(*) n, round(sum(round(cast(budget_amount as double) / tm * (1 + 1e-12), 2)), 2) daily_budget from t_bline b join cal on cal.period_key = b.period_key where tr = 1 group by all""")(
    lambda b: dims.budget_per_trading_day(b.budget_lines, order_days(b)).groupBy("entity_key", "full_date").agg(n(), F.round(F.sum("daily_budget"), 2).alias("daily_budget")))
query("entity_hierarchy", """with recursive h as (select entity_key ancestor_key, entity_key descendant_key, 0 depth from ents union all select h.ancestor_key, e.entity_key, h.depth + 1 from h join ents e on e.parent_key = h.descendant_key) select * from h""")(
    lambda b: dims.entity_hierarchy(b.entities))

# ---- order, limit, top-k --------------------------------------------------------------------------------------
balances = lambda b: b.trial_balance.groupBy("entity_key", "account_code").agg(F.sum("net").alias("balance"))
query("top_accounts_by_abs", f"select entity_key, account_code, {dec('sum(net)')} balance from tb group by all order by abs(sum(net)) desc, entity_key, account_code limit 20")(
    lambda b: balances(b).orderBy(F.abs("balance").desc(), "entity_key", "account_code").limit(20))
query("top_cost_centres", f"""select * from (select entity_key, cost_centre, cost, cast(rank() over (partition by entity_key order by cost desc, cost_centre) as integer) place from (
 select entity_key, cost_centre, {dec('sum(net)')} cost from tbx t join coa c on c.account_code = t.account_code where account_type = 'Expense' group by all)) where place <= 3""")(
    lambda b: access.top_per_group(b.cost_balance.join(b.accounts.where("account_type = 'Expense'").select("account_code"), "account_code").groupBy("entity_key", "cost_centre").agg(
        F.sum("net").alias("cost")), ["entity_key"], [F.col("cost").desc(), F.col("cost_centre")], 3))
query("nulls_last_order", "select period_key, entity_key, revenue_yoy_pct from t_pl where consolidation_scope = 'entity'")(
    lambda b: b.pl.where("consolidation_scope = 'entity'").select(*KEY, "revenue_yoy_pct").orderBy(F.col("revenue_yoy_pct").desc_nulls_last(), "period_key", "entity_key"))
query("latest_period_per_entity", f"select entity_key, max(period_key) latest_period, max_by(revenue, period_key) revenue from t_act where consolidation_scope = 'entity' group by all")(
    lambda b: b.pl.where("consolidation_scope = 'entity'").groupBy("entity_key").agg(F.max("period_key").alias("latest_period"), F.max_by("revenue", "period_key").alias("revenue")))
query("reconcile_gold_to_master", f"""with m as (select entity_key, account_code, closing_balance master_balance from bs_up where period_year = 2001 and period_month = 12),
 g as (select entity_key, case when left(account_code, 1) in ('1','2','3','4') then account_code else '419' end account_code, sum(net) gold_balance from tb group by all)
 select coalesce(g.entity_key, m.entity_key) entity_key, coalesce(g.account_code, m.account_code) account_code, {dec('gold_balance')} gold_balance, master_balance, {dec('coalesce(gold_balance, 0) - coalesce(master_balance, 0)')} difference,
 coalesce(abs(coalesce(gold_balance, 0) - coalesce(master_balance, 0)) <= abs(master_balance) * 0.001, false) within_tolerance from g full join m on g.entity_key = m.entity_key and g.account_code = m.account_code
 order by abs(coalesce(gold_balance, 0)) desc, 1, 2 limit 100""")(lambda b: access.reconcile(b))

# ---- access ---------------------------------------------------------------------------------------------------
query("rls_entity_scope", "select u.user_id, p.entity_key, count(*) n, sum(revenue) revenue from t_act p join usermap u on u.entity_key = p.entity_key where consolidation_scope = 'entity' and is_active and u.user_id in (3, 7, 11, 12, 20) group by all")(
    lambda b: access.user_views(b.pl.where("consolidation_scope = 'entity'"), b.user_map, [3, 7, 11, 12, 20]).groupBy("user_id", "entity_key").agg(n(), *summed("revenue")))
query("rls_group_scope", """select period_key, p.entity_key, revenue from t_act p join ents e on e.entity_key = p.entity_key where consolidation_scope = 'entity' and consolidation_group in (
 select consolidation_group from usermap u join ents x on x.entity_key = u.entity_key where user_id = 12 and is_active and "role" = 'CEO')""")(
    lambda b: access.group_scope(b.pl.where("consolidation_scope = 'entity'"), b.user_map, b.entities, 12).select(*KEY, "revenue"))
query("rls_cost_centre_scope", f"""select entity_key, cost_centre, {dec('sum(net)')} net, count(*) n from tbx where cost_centre in (select p_type from part where p_partkey = 8) group by all""")(
    lambda b: access.cost_centre_scope(b.cost_balance, b.t("part").where("p_partkey = 8").select(F.col("p_type").alias("cost_centre")))
    .groupBy("entity_key", "cost_centre").agg(*summed("net"), n()))
query("rls_auditor_scope", """select period_key, entity_key, revenue from t_act where consolidation_scope = 'entity' and entity_key in (1, 4, 9)""")(
    lambda b: access.auditor_scope(b.pl.where("consolidation_scope = 'entity'"), [1, 4, 9], "2002-06-30", K.AS_OF).select(*KEY, "revenue"))
query("rls_role_matrix", """select event_id, u."role", case when u."role" <> 'AUDITOR' then e.user_id end user_id, case when u."role" = 'CFO' then props end props, action from accesslog e join (select distinct user_id, "role" from usermap) u on u.user_id = e.user_id""")(
    lambda b: access.mask_columns(b.access_log.join(b.user_map.select("user_id", "role").distinct(), "user_id")).select("event_id", "role", "user_id", "props", "action"))
query("tenant_scope", f"select period_key, t.entity_key, account_code, {dec('sum(net)')} net from tb t join ents e on e.entity_key = t.entity_key where consolidation_group = 'ASIA' group by all")(
    lambda b: access.tenant_scope(b.trial_balance, b.entities, "ASIA").groupBy(*KEY, "account_code").agg(*summed("net")))
KEYS = access.ForeignKeys([("nation", ["n_regionkey"], "region", ["r_regionkey"]), ("customer", ["c_nationkey"], "nation", ["n_nationkey"]),
                           ("supplier", ["s_nationkey"], "nation", ["n_nationkey"]), ("orders", ["o_custkey"], "customer", ["c_custkey"]),
                           ("lineitem", ["l_orderkey"], "orders", ["o_orderkey"])])


def tenant_graph(b):
    """Rows and amounts per table that belong to one region; lines have no company, the customers of their orders do."""
    tables = {t: b.t(t) for t in ("region", "nation", "customer", "supplier", "orders", "lineitem")}
    scoped = KEYS.scoped(tables, "region", F.col("r_name") == "ASIA")
    value = {"customer": "c_acctbal", "supplier": "s_acctbal", "orders": "o_totalprice", "lineitem": "l_extendedprice"}
    rows = [scoped[t].agg(n(), F.sum((F.col(value[t]) if t in value else F.lit(0)).cast("decimal(18,2)")).alias("total")).select(F.lit(t).alias("table_name"), "n", "total") for t in tables]
    return reduce(lambda x, y: x.unionByName(y), rows)


query("tenant_scope_graph", f"""with r as (select r_regionkey from region where r_name = 'ASIA'), na as (select * from nation where n_regionkey in (from r)), c as (select * from customer where c_nationkey in (select n_nationkey from na)),
 s as (select * from supplier where s_nationkey in (select n_nationkey from na)), o as (select * from orders where o_custkey in (select c_custkey from c)), l as (select * from lineitem where l_orderkey in (select o_orderkey from o))
 select 'region' table_name, count(*) n, cast(0 as decimal(38,2)) total from r union all select 'nation', count(*), 0 from na union all select 'customer', count(*), {dec('sum(cast(c_acctbal as decimal(18,2)))')} from c
 union all select 'supplier', count(*), {dec('sum(cast(s_acctbal as decimal(18,2)))')} from s union all select 'orders', count(*), {dec('sum(cast(o_totalprice as decimal(18,2)))')} from o
 union all select 'lineitem', count(*), {dec('sum(cast(l_extendedprice as decimal(18,2)))')} from l""")(tenant_graph)
query("membership_diff", """with cur as (select user_id, entity_key from usermap where is_active), tgt as (select user_id, entity_key from usermap where (user_id + entity_key) % 3 <> 0)
 select *, 'ADD' change from (select * from tgt except select * from cur) union all select *, 'REMOVE' from (select * from cur except select * from tgt)""")(
    lambda b: access.membership_diff(b.user_map.where("is_active").select("user_id", "entity_key"), b.user_map.where((F.col("user_id") + F.col("entity_key")) % 3 != 0).select("user_id", "entity_key")))
query("access_review", """select user_id, action, count(*) actions, cast(min(event_ts) as date) first_day, cast(max(event_ts) as date) last_day from accesslog where event_ts >= timestamp '2024-01-20' and event_ts < timestamp '2024-01-27' group by all""")(
    lambda b: access.access_review(b.access_log, "2024-01-27", 7))
query("subject_access_request", "select event_id, user_id, action, value, props from accesslog where user_id = 8")(
    lambda b: b.access_log.where("user_id = 8").select("event_id", "user_id", "action", "value", "props"))
query("amount_in_millions_topn", "select period_key, entity_key, revenue_m from (select *, round(cast(revenue as double) / 1e6 * (1 + 1e-12), 2) revenue_m from t_act where consolidation_scope = 'entity') order by revenue desc, period_key, entity_key limit 500")(
    lambda b: b.pl.where("consolidation_scope = 'entity'").orderBy(F.col("revenue").desc(), "period_key", "entity_key").limit(500).select(
        *KEY, rnd(F.col("revenue").cast("double") / 1e6, 2).alias("revenue_m")))
