"""Data-quality rules, quarantine and audit summaries."""

from pyspark.sql import functions as F

from ..functions.money import ratio
from ..functions.periods import period_of_date
from ..operators import dq, fx, staging
from ..operators.statements import KEY, balance_check
from ..plans import constants as K
from .oracle_tables import TABLES, dec, over, ratio as sql_ratio
from .registry import query

n = lambda: F.count("*").alias("n")  # built when a query runs: the registry loads without a session
summed = lambda *cols: [F.sum(c).alias(c) for c in cols]

# the upload as delivered: some credit rows were lost, some currencies are missing or unknown
TABLES["up"] = """select * replace (case when partkey % 113 = 0 then null when partkey % 127 = 0 then 'XXX' else currency_code end as currency_code)
 from gl where not (side = 'C' and leg = 'S4' and partkey % 211 = 0)"""


def uploaded(b):
    return b.ledger().where("NOT (side = 'C' AND leg = 'S4' AND partkey % 211 = 0)").withColumn(
        "currency_code", F.when(F.col("partkey") % 113 == 0, None).when(F.col("partkey") % 127 == 0, "XXX").otherwise(F.col("currency_code")))


TABLES["dq1"] = f"""select batch_id, entity_code, {dec('sum(debit)')} total_debits, {dec('sum(credit)')} total_credits, count(*) records_checked, {dec('abs(sum(debit) - sum(credit))')} imbalance,
 case when abs(sum(debit) - sum(credit)) < 1 then 'PASS' else 'FAIL' end check_result from up group by all"""
query("dq001_balance", "select * from dq1")(lambda b: dq.batch_balance(uploaded(b)))
query("dq001_quarantine_batch", "select batch_id, entity_code, 'DQ-001' rule_id, 'Debits and credits differ by ' || cast(imbalance as varchar) reason, records_checked, date '2001-12-31' quarantined_on, 'OPEN' resolution_status from dq1 where check_result = 'FAIL'")(
    lambda b: dq.quarantine_batches(dq.batch_balance(uploaded(b)), K.AS_OF))
query("dq002_unmapped", f"select entity_code, account_code, period_key, count(*) n, {dec('sum(debit)')} debit from up where account_code not in (select account_code from coa) group by all")(
    lambda b: dq.run("DQ-002", uploaded(b), b.accounts)[0].groupBy("entity_code", "account_code", "period_key").agg(n(), *summed("debit")))
query("dq003_rollforward", f"""select b.entity_key, b.account_code, cast(b.period_key as integer) period_key, cast(abs(opening_balance + coalesce(movement, 0) - closing_balance) as decimal(38,2)) period_balance_gap
 from bs_stage b left join bs_moves m on m.entity_key = b.entity_key and m.account_code = b.account_code and m.mi = b.period_year * 12 + b.period_month - 1 where abs(opening_balance + coalesce(movement, 0) - closing_balance) > 1""")(
    lambda b: dq.rollforward_gaps(b.balance_upload, b.trial_balance))
query("dq004_zero_amount", "select entity_code, account_code, leg, count(*) n from up where debit = 0 and credit = 0 and not is_reversal group by all")(
    lambda b: uploaded(b).where(dq.is_zero_amount()).groupBy("entity_code", "account_code", "leg").agg(n()))
TABLES["dq5"] = "select *, case when posting_date is null then 'MISSING_POSTING_DATE' when document_date is null then 'MISSING_DOCUMENT_DATE' when document_date > posting_date then 'DOCUMENT_AFTER_POSTING' when posting_date > ingestion_date then 'POSTING_AFTER_INGESTION' end reason_code from up"
query("dq005_dates", "select entity_code, period_key, reason_code, count(*) n, max(document_date) latest_document from dq5 where reason_code is not null group by all")(
    lambda b: dq.run("DQ-005", uploaded(b))[0].groupBy("entity_code", "period_key", "reason_code").agg(n(), F.max("document_date").alias("latest_document")))
query("dq005_period_window", """select entity_code, period_key, count(*) n from up where document_date > posting_date or posting_date > date '2001-12-31' or posting_date < cast(date_trunc('month', document_date) as date) - 31
 or posting_date > last_day(document_date) + 31 group by all""")(
    lambda b: uploaded(b).where(dq.outside_period_window(period_of_date("document_date"), K.AS_OF)).groupBy("entity_code", "period_key").agg(n()))
KNOWN = ", ".join(f"'{c}'" for c in K.KNOWN_CURRENCIES)
query("dq006_currency", f"select entity_code, currency_code, count(*) n from up where currency_code is null or currency_code not in ({KNOWN}) group by all")(
    lambda b: dq.run("DQ-006", uploaded(b))[0].groupBy("entity_code", "currency_code").agg(n()))
TABLES["cover"] = """select distinct currency_code cc, cast(unnest(generate_series(cast(rate_date - 1 as date), cast(rate_date + 3 as date), interval 1 day)) as date) cd from rates"""
query("dq007_fx_available", "select entity_code, currency_code, count(*) n, min(posting_date) first_date from up left join cover on cc = currency_code and cd = posting_date where currency_code <> 'HUF' and cc is null group by all")(
    lambda b: dq.run("DQ-007", uploaded(b), rates=b.fx_rates)[0].groupBy("entity_code", "currency_code").agg(n(), F.min("posting_date").alias("first_date")))
query("dq008_duplicate_source", """select entity_code, source_system, source_id, leg, side, count(*) occurrences, min(batch_id) first_batch, max(batch_id) last_batch, min(posting_date) first_date, max(posting_date) last_date
 from up group by all having count(*) > 1""")(lambda b: dq.duplicate_sources(uploaded(b)))
TABLES["fp"] = """select transaction_id, entity_code, account_code, posting_date, net, sha256(entity_code || '|' || account_code || '|' || cast(posting_date as varchar) || '|' || document_number || '|' || cast(debit as varchar) || '|' || cast(credit as varchar)) row_hash from gl"""
FP = ["transaction_id", "entity_code", "account_code", "row_hash", "duplicate_count"]
query("dq_duplicate_postings", "select transaction_id, entity_code, account_code, row_hash, duplicate_count from (select *, count(*) over (partition by entity_code, row_hash) duplicate_count from fp) where duplicate_count > 1")(
    lambda b: dq.duplicate_postings(b.ledger(), staging.FINGERPRINT).select(*FP))
query("dq009_revenue_sign", f"""select entity_key, posting_date, g.account_code, {dec('sum(case when is_reversal then -net else net end)')} net_debit from gl g join coa c on c.account_code = g.account_code
 where lower(account_type) = 'revenue' and normal_balance = 'C' group by all having sum(case when is_reversal then -net else net end) > 0""")(
    lambda b: dq.revenue_with_debit(b.ledger().withColumn("net", F.when(F.col("is_reversal"), -F.col("net")).otherwise(F.col("net"))), b.accounts,
                                    ("entity_key", "posting_date", "account_code")))
LATE = "posting_date <= last_day(make_date(period_key // 100, period_key % 100, 1)) and ingestion_date > last_day(make_date(period_key // 100, period_key % 100, 1)) + 5"
query("dq010_late_entries", f"""select batch_id, entity_code, period_key, count(*) total_count, count(case when {LATE} then 1 end) late_count, {sql_ratio(f'count(case when {LATE} then 1 end)', 'count(*)', 4, 100)} late_rate_pct,
 case when count(case when {LATE} then 1 end) = 0 then 'PASS' else 'WARN' end check_result from up group by all""")(lambda b: dq.late_entries(uploaded(b)))
query("dq011_budget_bounds", f"""with py as (select entity_key, account_code, period_key + 100 period_key, sum(net) py_actual from tb group by all)
 select * from (select b.entity_key, b.account_code, b.period_key, budget_version, budget_amount, {dec('py_actual')} py_actual, {sql_ratio('budget_amount', 'abs(py_actual)', 4)} budget_to_py_ratio,
 case when cast(budget_amount as double) > abs(cast(py_actual as double)) * 3 then 'BUDGET_TOO_HIGH' when budget_amount > 0 and cast(budget_amount as double) < abs(cast(py_actual as double)) / 3 then 'BUDGET_TOO_LOW' end violation_type
 from bud b join py on py.entity_key = b.entity_key and py.account_code = b.account_code and py.period_key = b.period_key where abs(py_actual) >= 100000 and budget_amount <> 0) where violation_type is not null""")(
    lambda b: dq.budget_outliers(b.budget, b.trial_balance, minimum=100_000.0))
query("dq_bs_balances", """select period_key, entity_key, cast(sum(case when account_type = 'Asset' then closing_balance else -closing_balance end) as decimal(38,2)) balance_difference from bs_nodes group by all
 having abs(sum(case when account_type = 'Asset' then closing_balance else -closing_balance end)) >= 1""")(
    lambda b: balance_check(b.nodes).where("NOT is_balanced").select(*KEY, "balance_difference"))
COV = f"""with cov as (select entity_key, count(*) posted_accounts, count(c.account_code) mapped_accounts, {sql_ratio('count(c.account_code)', 'count(*)', 1, 100)} coverage_pct from (select distinct entity_key, account_code from tb) t
 left join coa c on c.account_code = t.account_code group by all having {sql_ratio('count(c.account_code)', 'count(*)', 1, 100)} < 97)"""
query("coverage_failures", COV + f" select t.entity_key, account_code, coverage_pct, {dec('sum(debit)')} debit, {dec('sum(credit)')} credit, cast(sum(postings) as bigint) postings from tb t join cov on cov.entity_key = t.entity_key where account_code not in (select account_code from coa) group by all")(
    lambda b: dq.unmapped_by_value(b.trial_balance, b.accounts, dq.coverage(b.trial_balance, b.accounts, 97.0).select("entity_key", "coverage_pct")))
query("dq_coa_coverage", COV + " select * from cov")(lambda b: dq.coverage(b.trial_balance, b.accounts, 97.0))
# accounts of the sale of goods between companies, the only income that the templates post
IC_SOLD, IC_BOUGHT = next((sold, bought) for kind, _, sold, bought in K.IC_TYPES if kind == "GOODS_SALE")
IC = f"""select period_key, {dec(f"sum(case when account_code = '{IC_SOLD}' then -net else 0 end)")} sold, {dec(f"sum(case when account_code = '{IC_BOUGHT}' then net else 0 end)")} bought from tb where is_intercompany group by all"""


def ic_balance(b):
    """Intercompany income must equal intercompany cost, and the group scope must hold no intercompany income."""
    ic = b.mapped.where("is_intercompany").groupBy("period_key").agg(
        F.sum(F.when(F.col("account_code") == IC_SOLD, -F.col("net")).otherwise(0)).alias("sold"), F.sum(F.when(F.col("account_code") == IC_BOUGHT, F.col("net")).otherwise(0)).alias("bought"))
    both = b.pl.groupBy("period_key").agg(
        F.sum(F.when(F.col("consolidation_scope") == "entity", F.col("revenue")).otherwise(-F.col("revenue"))).alias("scope_difference"))
    gap = F.col("sold") - F.col("bought")
    return ic.join(both, "period_key").select("period_key", "sold", "bought", gap.alias("net_elimination"), (F.abs(gap) <= 1).alias("nets_to_zero"),
                                              (F.col("scope_difference") - F.col("sold")).alias("ic_left_in_group"))


query("dq_ic_balance", f"""select i.*, sold - bought net_elimination, abs(sold - bought) <= 1 nets_to_zero, {dec('scope_difference - sold')} ic_left_in_group from ({IC}) i
 join (select period_key, sum(case when consolidation_scope = 'entity' then revenue else -revenue end) scope_difference from t_act group by all) s on s.period_key = i.period_key""")(ic_balance)
query("dq_normal_balance", "select t.account_code, account_type, normal_balance, cast(sum(postings) as bigint) postings from tb t join coa c on c.account_code = t.account_code where normal_balance <> case when account_type in ('Asset', 'Expense') then 'D' else 'C' end group by all")(
    lambda b: dq.wrong_normal_balance(b.mapped))


def signed_check(b):
    """Signed amounts as delivered (income rows of some parts come with the sign of the ledger) against the formula."""
    from ..operators.accounts import map_accounts, signed_amount
    mapped = map_accounts(b.ledger(), b.accounts)
    delivered = mapped.withColumn("signed", F.when((F.col("partkey") % 89 == 0) & (F.col("account_type") == "Revenue"), F.col("debit") - F.col("credit")).otherwise(F.col("signed")))
    return delivered.groupBy("account_type").agg(n(), F.count(F.when(F.abs(F.col("signed") - signed_amount()) > 1, 1)).alias("violations"), F.sum("signed").alias("signed"))


_SIGNED = "case when account_type = 'Revenue' and partkey % 89 <> 0 then credit - debit else debit - credit end"
query("dq_signed_amount", f"""select account_type, count(*) n, count(case when account_type = 'Revenue' and partkey % 89 = 0 and 2 * abs(debit - credit) > 1 then 1 end) violations, {dec(f'sum({_SIGNED})')} signed
 from gl g join coa c on c.account_code = g.account_code group by all""")(signed_check)


def fx_direction(b):
    """EUR must be the home amount times the rate, and the rate it implies must be plausible."""
    c = fx.convert_exact_date(b.ledger(), b.fx_rates)
    back = F.abs(F.col("net").cast("double") * F.col("huf_to_eur_rate") - F.col("net_eur").cast("double"))
    implied = ratio(F.col("net"), F.col("net_eur"))
    return c.groupBy("currency_code").agg(n(), F.count(F.when(back > 1, 1)).alias("off_by_more_than_one"), F.count(F.when(~implied.between(200, 600), 1)).alias("implausible_rate"))


_R = "coalesce(1 / cast(rate_to_huf as double), 1.0::double / 400)"
query("dq_fx_direction", f"""select currency_code, count(*) n, count(case when abs(cast(net as double) * r - cast(e as double)) > 1 then 1 end) off_by_more_than_one,
 count(case when e <> 0 and not (cast(net as double) / cast(e as double) between 200 and 600) then 1 end) implausible_rate from (select g.currency_code, net, {_R} r, {over('net', 'coalesce(rate_to_huf, 400)')} e from gl g left join rates x on x.rate_date = posting_date and x.currency_code = 'EUR') group by all""")(fx_direction)
query("dq_huf_passthrough", f"select currency_code is null or currency_code = 'HUF' is_home, count(*) n, count(case when partkey % 83 = 0 then 1 end) changed, {dec('sum(net)')} net from up where currency_code is null or currency_code = 'HUF' group by all")(
    # amounts as delivered: home-currency rows of some parts were converted by mistake
    lambda b: fx.convert_exact_date(uploaded(b), b.fx_rates).where("currency_code IS NULL OR currency_code = 'HUF'").withColumn(
        "net_lcy_fx_adjusted", F.when(F.col("partkey") % 83 == 0, F.col("net") + 1).otherwise(F.col("net_lcy_fx_adjusted"))).groupBy(F.lit(True).alias("is_home")).agg(
        n(), F.count(F.when(F.col("net_lcy_fx_adjusted") != F.col("net"), 1)).alias("changed"), *summed("net")))
query("dq_schema_tests", f"""with u as (select * from up), t as (select 'not_null:entity_code' test, count(case when entity_code is null then 1 end) failures from u union all select 'not_null:currency_code', count(case when currency_code is null then 1 end) from u
 union all select 'not_null:posting_date', count(case when posting_date is null then 1 end) from u union all select 'accepted_values:side', count(case when side not in ('D', 'C') then 1 end) from u
 union all select 'accepted_values:currency_code', count(case when currency_code not in ({KNOWN}) then 1 end) from u union all select 'unique:transaction_id', count(*) - count(distinct transaction_id) from u)
 select test, failures, case when failures = 0 then 'PASS' else 'FAIL' end check_result from t""")(
    lambda b: dq.schema_tests(uploaded(b), ["entity_code", "currency_code", "posting_date"], {"side": ["D", "C"], "currency_code": K.KNOWN_CURRENCIES}, ["transaction_id"]))
_RULES = {"DQ-002": "account_code not in (select account_code from coa)", "DQ-004": "debit = 0 and credit = 0 and not is_reversal",
          "DQ-005": "reason_code is not null", "DQ-006": f"currency_code is null or currency_code not in ({KNOWN})",
          "DQ-007": "currency_code <> 'HUF' and cc is null", "DQ-010": LATE}
TABLES["dqlog0"] = " union all ".join(
    [f"select '{r}' rule_id, entity_code, count(*) records_checked, count(case when {c} then 1 end) records_failed from dq5 left join cover on cc = currency_code and cd = posting_date group by all" for r, c in _RULES.items()]
    + ["select 'DQ-001', entity_code, count(*), count(case when check_result = 'FAIL' then 1 end) from dq1 group by all",
       "select 'DQ-008', entity_code, cast(sum(n) as bigint), count(case when n > 1 then 1 end) from (select entity_code, source_system, source_id, leg, side, count(*) n from up group by all) group by all",
       """select 'DQ-003', entity_code, count(*), count(case when abs(opening_balance + coalesce(movement, 0) - closing_balance) > 1 then 1 end) from bs_stage b join ents e on e.entity_key = b.entity_key
 left join bs_moves m on m.entity_key = b.entity_key and m.account_code = b.account_code and m.mi = b.period_year * 12 + b.period_month - 1 group by all""",
       """select 'DQ-009', entity_code, count(*), count(case when s > 0 then 1 end) from (select entity_code, posting_date, u.account_code, sum(case when is_reversal then -net else net end) s from up u
 join coa c on c.account_code = u.account_code where lower(account_type) = 'revenue' and normal_balance = 'C' group by all) group by all""",
       """select 'DQ-011', entity_code, count(*), count(case when cast(budget_amount as double) > abs(cast(py_actual as double)) * 3 or (budget_amount > 0 and cast(budget_amount as double) < abs(cast(py_actual as double)) / 3) then 1 end)
 from bud b join (select entity_key, account_code, period_key + 100 period_key, sum(net) py_actual from tb group by all) py on py.entity_key = b.entity_key and py.account_code = b.account_code and py.period_key = b.period_key
 join ents e on e.entity_key = b.entity_key where abs(py_actual) >= 100000 and budget_amount <> 0 group by all"""])
TABLES["dqlog"] = f"""select *, {sql_ratio('records_failed', 'records_checked', 4, 100)} failure_rate_pct, case when records_failed = 0 then 'PASS' when rule_id in ('DQ-004', 'DQ-007', 'DQ-009', 'DQ-010', 'DQ-011') then 'WARN' else 'FAIL' end check_result,
 case when records_failed = 0 then 'NONE' when rule_id in ('DQ-001', 'DQ-002') then 'QUARANTINE' when rule_id in ('DQ-004', 'DQ-007', 'DQ-009', 'DQ-010', 'DQ-011') then 'WARN' when rule_id = 'DQ-003' then 'ALERT' else 'BLOCK' end action_taken from dqlog0"""
def full_log(b):
    u = uploaded(b)
    return dq.dq_log(u, b.accounts, b.fx_rates, monthly=dq.monthly_counts(u, b.accounts, b.entities, b.balance_upload, b.trial_balance, b.budget, 100_000.0))


log = lambda b: b.stored("dq_log", lambda: full_log(b))
query("dq_log", "select * from dqlog")(full_log)
query("dq_pass_rate", f"select rule_id, count(*) checks, count(case when check_result = 'PASS' then 1 end) passed, {sql_ratio("count(case when check_result = 'PASS' then 1 end)", 'count(*)', 4, 100)} pass_rate_pct, {sql_ratio('sum(records_failed)', 'sum(records_checked)', 4, 100)} failure_rate_pct from dqlog group by all")(
    lambda b: log(b).groupBy("rule_id").agg(n().alias("checks"), F.count(F.when(F.col("check_result") == "PASS", 1)).alias("passed"), F.sum("records_failed").alias("_f"), F.sum("records_checked").alias("_c")).select(
        "rule_id", "checks", "passed", ratio(F.col("passed"), F.col("checks"), 4, 100).alias("pass_rate_pct"), ratio(F.col("_f"), F.col("_c"), 4, 100).alias("failure_rate_pct")))
query("m_dq_pass_rate_pct", f"select entity_code, {sql_ratio("count(case when check_result = 'PASS' then 1 end)", 'count(*)', 6)} dq_pass_rate_pct from dqlog group by all")(
    lambda b: log(b).groupBy("entity_code").agg(F.count("*").alias("_n"), F.count(F.when(F.col("check_result") == "PASS", 1)).alias("_p")).select(
        "entity_code", ratio(F.col("_p"), F.col("_n"), 6).alias("dq_pass_rate_pct")))


def gate_decision(b):
    """The gate as a branch of the close: the one count it needs decides whether the pipeline goes on."""
    try:
        failures, decision = dq.gate(log(b)), "CONTINUE"
    except dq.GateClosed:
        decision, failures = "HALT", None
    return log(b).where(F.col("rule_id").isin(*dq.CRITICAL)).groupBy("rule_id").agg(
        F.count(F.when(F.col("check_result") == dq.FAIL, 1)).alias("critical_failures")).withColumn("decision", F.lit(decision))


query("dq_gate", """select rule_id, count(case when check_result = 'FAIL' then 1 end) critical_failures, (select case when count(case when check_result = 'FAIL' then 1 end) > 0 then 'HALT' else 'CONTINUE' end from dqlog where rule_id in ('DQ-001', 'DQ-002')) decision
 from dqlog where rule_id in ('DQ-001', 'DQ-002') group by all""")(gate_decision)
query("dq_detail_json", f"""select entity_code, count(*) invalid_count, cast(to_json({{'rule_id': 'DQ-006', 'invalid_count': count(*), 'samples': list({{'transaction_id': transaction_id, 'account_code': account_code, 'net': cast(net as varchar)}} order by transaction_id)[1:10]}}) as varchar) failure_detail
 from up where currency_code is null or currency_code not in ({KNOWN}) group by all""")(lambda b: dq.detail_json(dq.run("DQ-006", uploaded(b))[0], "DQ-006", ["transaction_id", "account_code", "net"], ["transaction_id"]))
def violations(b):
    u = uploaded(b)
    text = lambda rule, df, key, detail: df.select(F.lit(rule).alias("rule_id"), "entity_code", F.col(key).cast("string").alias("violating_key"), detail.cast("string").alias("detail"))
    return text("DQ-001", dq.batch_balance(u).where("check_result = 'FAIL'"), "batch_id", F.col("imbalance").cast("decimal(38,2)")).unionByName(
        text("DQ-002", dq.run("DQ-002", u, b.accounts)[0], "transaction_id", F.col("account_code"))).unionByName(
        text("DQ-008", dq.duplicate_sources(u), "source_id", F.col("occurrences")))


query("violations_union", """select 'DQ-001' rule_id, entity_code, batch_id violating_key, cast(imbalance as varchar) detail from dq1 where check_result = 'FAIL' union all
 select 'DQ-002', entity_code, transaction_id, account_code from up where account_code not in (select account_code from coa) union all
 select 'DQ-008', entity_code, source_id, cast(count(*) as varchar) from up group by entity_code, source_system, source_id, leg, side having count(*) > 1""")(violations)

# ---- quarantine queue -----------------------------------------------------------------------------------------
TABLES["quar"] = """select transaction_id, batch_id, entity_code, account_code, net, ingestion_date quarantined_on, case when partkey % 3 = 0 then 'RESOLVED' else 'OPEN' end resolution_status from gl where account_code not in (select account_code from coa)"""


def quarantine(b):
    from ..operators.accounts import quarantine_unmapped
    return quarantine_unmapped(b.ledger(), b.accounts).select(
        "transaction_id", "batch_id", "entity_code", "account_code", "net", F.col("ingestion_date").alias("quarantined_on"),
        F.when(F.col("partkey") % 3 == 0, "RESOLVED").otherwise("OPEN").alias("resolution_status"))


def quarantine_open(b):
    """Open rows with their age and the totals of their batch. Sorted output: oldest first."""
    batches = b.trial_balance.join(b.entities.select("entity_key", "entity_code"), "entity_key").groupBy(
        F.concat_ws("-", "period_key", "entity_code").alias("batch_id")).agg(F.sum("postings").alias("batch_rows"))
    return quarantine(b).where("resolution_status = 'OPEN'").join(batches, "batch_id").withColumn(
        "age_days", F.date_diff(F.to_date(F.lit("2002-03-31")), "quarantined_on")).orderBy(F.col("age_days").desc(), "transaction_id")


query("quarantine_open", """select q.*, cast(batch_rows as bigint) batch_rows, cast(date_diff('day', quarantined_on, date '2002-03-31') as integer) age_days from quar q
 join (select cast(period_key as varchar) || '-' || entity_code batch_id, sum(postings) batch_rows from tb t join ents e on e.entity_key = t.entity_key group by all) b on b.batch_id = q.batch_id where resolution_status = 'OPEN'""")(quarantine_open)
query("m_open_quarantine_count", "select entity_code, count(*) open_quarantine_count from quar where resolution_status = 'OPEN' group by all")(
    lambda b: quarantine(b).where("resolution_status = 'OPEN'").groupBy("entity_code").agg(F.count("*").alias("open_quarantine_count")))


def freshness(b):
    as_of = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    latest = lambda name, df, c: df.agg(F.max(F.col(c).cast("timestamp")).alias("m")).select(F.lit(name).alias("table_name"), "m")
    rows = latest("orders", b.t("orders"), "o_orderdate").unionByName(latest("lineitem", b.t("lineitem"), "l_shipdate")).unionByName(latest("events", b.t("events"), "ts"))
    hours = F.floor((F.unix_timestamp(as_of) - F.unix_timestamp("m")) / 3600).cast("long")
    return rows.select("table_name", F.to_date("m").alias("latest_day"), hours.alias("hours_stale"), (hours > 4).alias("is_stale"), (hours > 6).alias("is_alert"))


query("freshness", """select table_name, cast(m as date) latest_day, h hours_stale, h > 4 is_stale, h > 6 is_alert from (select *, cast(floor((epoch(timestamp '2024-02-01') - floor(epoch(m))) / 3600) as bigint) h from (
 select 'orders' table_name, max(o_orderdate) m from orders union all select 'lineitem', max(l_shipdate) from lineitem union all select 'events', max(ts) from events))""")(freshness)
