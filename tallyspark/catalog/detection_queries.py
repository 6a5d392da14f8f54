"""Anomalies, forecasts, retrieval and column statistics."""

from pyspark.sql import functions as F

from ..operators import accounts as acc, anomaly as A, dq, forecast as P, retrieval as R
from ..operators.statements import KEY, balance_check
from ..sources import sinks
from .oracle_tables import TABLES, dec
from .registry import query

n = lambda: F.count("*").alias("n")  # built when a query runs: the registry loads without a session
CURRENT = 200106
E = "consolidation_scope = 'entity'"
TABLES["hist"] = f"""select p.period_key, p.entity_key, revenue, ebitda, ebitda_margin_pct, gross_margin_pct, net_profit, revenue_variance_pct, current_ratio, dso_days, dpo_days, net_debt_ebitda, free_cash_flow
 from t_prof p left join (select period_key pk, entity_key ek, current_ratio, dso_days, dpo_days, net_debt_ebitda from t_liq where {E}) l on pk = p.period_key and ek = p.entity_key
 left join (select period_key pk2, entity_key ek2, free_cash_flow from t_ck where {E}) c on pk2 = p.period_key and ek2 = p.entity_key where {E} and p.period_key > 199906 and p.period_key <= {CURRENT}"""
TABLES["histl"] = " union all ".join(f"select entity_key, period_key, '{k}' kpi, cast({k} as double) \"value\" from hist where {k} is not null" for k in A.KPI_COLUMNS)
history = lambda b: A.kpi_history(b.profitability, b.liquidity, b.cash_kpis, CURRENT)
query("kpi_history", "select * from hist")(history)
SEVZ = "case when abs(z) > 3.5 then 'CRITICAL' when abs(z) > 3 then 'HIGH' else 'MEDIUM' end severity"
R4 = lambda c, name: F.round(F.col(c) * F.lit(1 + 1e-12), 4).alias(name)
TABLES["zs"] = f"""select *, {SEVZ} from (select h.entity_key, h.kpi, h.period_key, h."value", m, s, (h."value" - m) / s z from histl h join (select entity_key, kpi, count(*) c, avg("value") m, stddev_samp("value") s from histl where period_key <> {CURRENT} group by all) p
 on p.entity_key = h.entity_key and p.kpi = h.kpi where h.period_key = {CURRENT} and c >= 3 and s > 1e-9) where abs(z) > 1.5"""
query("anomaly_zscore", "select entity_key, period_key, kpi, round(z * (1 + 1e-12), 4) z_score, severity from zs")(
    lambda b: A.zscores(history(b), CURRENT, 1.5).select(*KEY, "kpi", R4("z_score", "z_score"), "severity"))
query("anomaly_zscore_rolling12", f"""select entity_key, period_key, kpi, c n, round(z * (1 + 1e-12), 4) z_score, {SEVZ} from (select *, ("value" - m) / s z from (select *, count("value") over w c, avg("value") over w m, stddev_samp("value") over w s from histl
 window w as (partition by entity_key, kpi order by (period_key // 100) * 12 + period_key % 100 range between 12 preceding and 1 preceding)) where c >= 3 and s > 1e-9) where abs(z) > 2.5""")(
    lambda b: A.zscores_rolling(history(b)).select(*KEY, "kpi", "n", R4("z_score", "z_score"), "severity"))
query("anomaly_isolation_forest")(lambda b: A.isolation_forest(history(b), CURRENT))
query("anomaly_budget_gate", "select period_key, entity_key, revenue_variance_pct from hist where revenue_variance_pct < -15")(lambda b: A.budget_gate(history(b)))
TABLES["storno"] = "select * replace (case when is_reversal then -net else net end as net) from gl"
storno = lambda b: b.ledger().withColumn("net", F.when(F.col("is_reversal"), -F.col("net")).otherwise(F.col("net")).cast("decimal(18,2)"))


def storno_mapped(b):
    """Mapped postings where a reversal keeps its side and turns its sign."""
    s = F.when(F.col("account_type") == "Revenue", -F.col("net")).otherwise(F.col("net"))
    return storno(b).join(b.accounts, "account_code").withColumn("signed", s)


query("anomaly_revenue_debit", f"select entity_key, period_key, count(*) as \"rows\", {dec('sum(-net)')} total from storno s join coa c on c.account_code = s.account_code where l1_category = 'Revenue' and -net < 0 group by all")(
    lambda b: A.revenue_debits(storno_mapped(b)))
TABLES["fpz"] = """select transaction_id, entity_code, account_code, period_key, sha256(entity_code || '|' || account_code || '|' || period_key || '|' || cast(debit as varchar) || '|' || cast(credit as varchar)) row_hash from gl"""
query("anomaly_duplicate_hash", "select entity_code, row_hash, duplicate_count, count(*) n from (select *, count(*) over (partition by entity_code, row_hash) duplicate_count from fpz) where duplicate_count > 1 group by all")(
    lambda b: dq.duplicate_postings(b.ledger(), ["entity_code", "account_code", "period_key", "debit", "credit"])
    .groupBy("entity_code", "row_hash", "duplicate_count").agg(n()))
query("anomaly_bs_imbalance", """select period_key, entity_key, total_assets, total_liabilities_equity, total_assets - total_liabilities_equity gap from (select period_key, entity_key, cast(sum(case when account_type = 'Asset' then closing_balance else 0 end) as decimal(38,2)) total_assets,
 cast(sum(case when account_type <> 'Asset' then closing_balance else 0 end) as decimal(38,2)) total_liabilities_equity from bs_nodes group by all) where abs(total_assets - total_liabilities_equity) >= 1""")(
    lambda b: balance_check(b.nodes).where("NOT is_balanced").select(*KEY, "total_assets", "total_liabilities_equity", F.col("balance_difference").alias("gap")))
query("anomaly_large_posting", "select transaction_id, document_number, universal_node, net from gl g join coa c on c.account_code = g.account_code where abs(net) > 100000")(
    lambda b: A.large_postings(acc.map_accounts(b.ledger(), b.accounts), 100_000).select("transaction_id", "document_number", "universal_node", "net"))
query("anomaly_missing_accrual", """with a as (select distinct entity_key, account_code, period_key from tb where account_code in ('56', '861')),
 e as (select entity_key, account_code, unnest(range(min((period_key // 100) * 12 + period_key % 100 - 1), 24024)) i from a group by 1, 2)
 select entity_key, account_code, cast((i // 12) * 100 + i % 12 + 1 as integer) period_key from e where not exists (select 1 from a where a.entity_key = e.entity_key and a.account_code = e.account_code and a.period_key = (i // 12) * 100 + i % 12 + 1)""")(
    lambda b: A.missing_accruals(b.trial_balance, ["56", "861"], 200112))
OFF = "posting_hour < 7 or posting_hour > 22"
query("anomaly_off_hours", f"select entity_key, period_key, count(*) off_hours_postings from gl where {OFF} group by all having count(*) > 5")(lambda b: A.off_hours(b.ledger()))
query("anomaly_velocity", "select posting_date, universal_node, count(*) daily_count from gl g join coa c on c.account_code = g.account_code group by all having count(*) > 50")(
    lambda b: A.velocity(acc.map_accounts(b.ledger(), b.accounts)))


LARGE, FAST = 100_000, 5


def anomaly_queue(b, with_forest):
    mapped = acc.map_accounts(b.ledger(), b.accounts)
    # the month is part of the fingerprint, so a posting's copies are in its own month
    same = dq.duplicate_postings(b.ledger().where(F.col("period_key") == CURRENT), ["entity_code", "account_code", "period_key", "debit", "credit"])
    return A.build_queue(history(b), CURRENT, b.ledger(), storno_mapped(b), balance_check(b.nodes), mapped, same, LARGE, FAST, with_forest)


def queue_rows(b, with_forest):
    return anomaly_queue(b, with_forest).select(
        "entity_key", "period_key", "anomaly_class", "detection_method", "severity", "kpi_affected", *[F.round(F.col(c) * (1 + 1e-12), 2).alias(c) for c in A.EVIDENCE[:3]],
        R4("z_score", "z_score"), "anomaly_score", "status")


# the whole queue; a forest has no SQL, so a test compares it with the rules' rows below and with a plain forest
query("anomaly_queue")(lambda b: queue_rows(b, True))
_FOUND = "cast(count(*) as double)"
query("anomaly_queue_rules", f"""with f as (select *, count(*) over (partition by entity_code, row_hash) c from (select entity_key, entity_code, period_key, sha256(entity_code || '|' || account_code || '|' || period_key || '|' || cast(debit as varchar) || '|' || cast(credit as varchar)) row_hash from gl)),
 gm as (select g.*, universal_node from gl g join coa c on c.account_code = g.account_code where period_key = {CURRENT}),
 q as (select entity_key, 'STATISTICAL' anomaly_class, 'ZSCORE' detection_method, severity, kpi kpi_affected, "value" current_value, m historical_mean, s historical_std, z z_score from zs where abs(z) > 2.5
 union all select entity_key, 'STATISTICAL', 'BUDGET_GATE', 'HIGH', 'revenue_variance_pct', cast(revenue_variance_pct as double), null, null, null from hist where revenue_variance_pct < -15 and period_key = {CURRENT}
 union all select entity_key, 'STRUCTURAL', 'RULE_ENGINE', 'HIGH', 'REVENUE_ACCOUNTS', {_FOUND}, null, null, null from storno s join coa c on c.account_code = s.account_code where l1_category = 'Revenue' and net > 0 and period_key = {CURRENT} group by entity_key
 union all select entity_key, 'STRUCTURAL', 'RULE_ENGINE', 'CRITICAL', 'BALANCE_SHEET_EQUATION', cast(sum(case when account_type = 'Asset' then closing_balance else -closing_balance end) as double), null, null, null from bs_nodes where period_key = {CURRENT} group by entity_key
  having abs(sum(case when account_type = 'Asset' then closing_balance else -closing_balance end)) >= 1
 union all select entity_key, 'BEHAVIOURAL', 'RULE_ENGINE', 'MEDIUM', 'OFF_HOURS_POSTINGS', {_FOUND}, null, null, null from gl where ({OFF}) and period_key = {CURRENT} group by entity_key having count(*) > 5
 union all select entity_key, 'STRUCTURAL', 'RULE_ENGINE', 'HIGH', 'DUPLICATE_POSTINGS', {_FOUND}, null, null, null from f where c > 1 and period_key = {CURRENT} group by entity_key
 union all select entity_key, 'BEHAVIOURAL', 'RULE_ENGINE', 'HIGH', 'LARGE_POSTINGS', {_FOUND}, null, null, null from gm where abs(net) > {LARGE} group by entity_key
 union all select entity_key, 'BEHAVIOURAL', 'RULE_ENGINE', 'MEDIUM', 'POSTING_VELOCITY', cast(max(n) as double), null, null, null from (select entity_key, posting_date, universal_node, count(*) n from gm group by all having count(*) > {FAST}) group by entity_key)
 select entity_key, {CURRENT} period_key, anomaly_class, detection_method, severity, kpi_affected, round(current_value * (1 + 1e-12), 2) current_value, round(historical_mean * (1 + 1e-12), 2) historical_mean,
 round(historical_std * (1 + 1e-12), 2) historical_std, round(z_score * (1 + 1e-12), 4) z_score, cast(null as double) anomaly_score, 'OPEN' status from q""")(
    lambda b: queue_rows(b, False))

# ---- forecasts ------------------------------------------------------------------------------------------------
TABLES["ser"] = """select s.*, (period_key // 100) * 12 + period_key % 100 - 1 mi from (select period_key, entity_key, unnest(['revenue', 'cogs', 'gross_profit', 'ebitda', 'net_profit', 'operating_cash_flow']) kpi,
  unnest([revenue, cogs, gross_profit, ebitda, net_profit, ocf]) "value" from (select p.*, operating_cash_flow ocf from t_pl p left join (select period_key pk, entity_key ek, consolidation_scope cs, operating_cash_flow from t_cf) c on pk = p.period_key and ek = p.entity_key and cs = p.consolidation_scope
  where consolidation_scope = 'entity')) s where "value" is not null"""
TABLES["mch"] = "select entity_key, kpi, count(*) as \"months\", cast(min(mi) as integer) first_mi, cast(max(mi) as integer) last_mi, case when count(*) >= 12 then 'SEASONAL' when count(*) >= 6 then 'DRIFT' else 'SKIP' end \"method\" from ser group by all"


def monthly_series(b):
    return P.series(b.pl, b.cashflow)


TABLES["tr0"] = """select s.entity_key, s.kpi, first_mi, last_mi, cast(count(*) as double) n, cast(sum(mi - first_mi) as double) st, cast(sum((mi - first_mi) * (mi - first_mi)) as double) stt, cast(sum("value") as double) sy, cast(sum("value" * (mi - first_mi)) as double) sty
 from ser s join mch c on c.entity_key = s.entity_key and c.kpi = s.kpi where "method" = 'SEASONAL' group by all"""
TABLES["tr"] = "select *, (sy - slope * st) / n intercept from (select *, (n * sty - st * sy) / (n * stt - st * st) slope from tr0)"
TABLES["sea"] = """select entity_key, kpi, m, case when abs(a * c + b * ts) > 1e-9 then y / (a * c + b * ts) else 1.0::double end season from (select s.entity_key, s.kpi, mi % 12 m, cast(sum("value") as double) y, cast(sum(mi - first_mi) as double) ts, cast(count(*) as double) c, max(slope) b, max(intercept) a
 from ser s join tr t on t.entity_key = s.entity_key and t.kpi = s.kpi group by all)"""
_RES = '(cast("value" as double) - (intercept + slope * (mi - first_mi)) * season)'
TABLES["sig"] = f"select s.entity_key, s.kpi, sqrt(sum({_RES} * {_RES}) / (count(*) - 2)) sigma from ser s join tr t on t.entity_key = s.entity_key and t.kpi = s.kpi join sea e on e.entity_key = s.entity_key and e.kpi = s.kpi and e.m = mi % 12 group by all"
_P = lambda i: f"cast((({i}) // 12) * 100 + ({i}) % 12 + 1 as integer)"
_r = lambda e: f"round(({e}) * (1 + 1e-12), 2)"
TABLES["fseas"] = f"""select entity_key, kpi, {_P('fi')} period_key, 'SEASONAL' "method", {_r('yhat - spread')} p10, {_r('yhat')} p50, {_r('yhat + spread')} p90 from (select f.*, (intercept + slope * (fi - first_mi)) * coalesce(season, 1.0::double) yhat, sigma * 1.2816::double spread
 from (select *, last_mi + unnest(range(1, 13)) fi from tr) f left join sea e on e.entity_key = f.entity_key and e.kpi = f.kpi and e.m = fi % 12 join sig g on g.entity_key = f.entity_key and g.kpi = f.kpi)"""
TABLES["fdrift"] = f"""select entity_key, kpi, {_P('last_mi + step')} period_key, 'DRIFT' "method", {_r('yhat - spread')} p10, {_r('yhat')} p50, {_r('yhat + spread')} p90 from (select *, lv + step * (lv - fv) / k yhat, sigma * 1.2816::double * sqrt(step) spread from (select *, unnest(range(1, 13)) step from (
 select entity_key, kpi, cast(max_by("value", mi) as double) lv, cast(min_by("value", mi) as double) fv, count(*) - 1 k, stddev_samp(d) sigma, max(mi) last_mi from (select s.*, cast("value" - lag("value") over (partition by s.entity_key, s.kpi order by mi) as double) d from ser s join mch c on c.entity_key = s.entity_key and c.kpi = s.kpi where "method" <> 'SKIP') group by 1, 2)))"""
query("forecast_method_choice", "select * from mch")(lambda b: P.method_choice(monthly_series(b)))
query("forecast_grid", f"select entity_key, kpi, {_P('last_mi + step')} period_key, cast(step as integer) step from (select *, unnest(range(1, 13)) step from mch where \"method\" <> 'SKIP')")(
    lambda b: P.grid(P.method_choice(monthly_series(b)).where("method <> 'SKIP'")).select(*P.KEYS, "period_key", "step"))
query("forecast_seasonal", "select * from fseas")(lambda b: P.seasonal(monthly_series(b)))
query("forecast_drift", "select * from fdrift")(lambda b: P.drift(monthly_series(b), methods=("SEASONAL", "DRIFT")))


def forecast_upsert(b):
    """Replace the forecasts of a company, month, KPI and source; older runs of other sources stay."""
    new = P.forecast(monthly_series(b)).withColumn("source", F.lit("RUN"))
    old = new.where("entity_key % 2 = 0").withColumn("p50", F.lit(0.0)).unionByName(new.where("entity_key % 3 = 0").withColumn("source", F.lit("MANUAL")))
    return sinks.merged(old, new, ["entity_key", "period_key", "kpi", "source"])


query("forecast_upsert", """with f as (select * from fseas union all select d.* from fdrift d join mch c on c.entity_key = d.entity_key and c.kpi = d.kpi where c."method" = 'DRIFT') select *, 'RUN' source from f union all select *, 'MANUAL' from f where entity_key % 3 = 0""")(forecast_upsert)

# ---- retrieval, profile ---------------------------------------------------------------------------------------
QUERY = [((i * 37) % 11 - 5) / 10 for i in range(64)]
WORDS = ["the", "data", "er"]
_V = "list_transform(embedding, lambda x: cast(x as double))"
_Q = "[" + ", ".join(f"{x!r}::double" for x in QUERY) + "]"
_SUM = lambda e: f"list_reduce(list_prepend(0.0::double, {e}), lambda a, x: a + x)"
query("schema_doc_knn", f"""select doc_id, round(0.7::double * ({_SUM(f'list_transform(list_zip({_V}, {_Q}), lambda p: p[1] * p[2])')} / (sqrt({_SUM(f'list_transform({_V}, lambda x: x * x)')}) * {sum(x * x for x in QUERY) ** 0.5!r}::double))
 + (1 - 0.7::double) * (cast({' + '.join(f"contains(lower(text), '{w}')::int" for w in WORDS)} as double) / 3), 6) score from documents join embeddings on vec_id = doc_id order by score desc, doc_id limit 25""")(
    lambda b: R.top_matches(b.t("documents").select("doc_id", "text").join(b.t("embeddings").select("vec_id", "embedding"), F.col("vec_id") == F.col("doc_id")), QUERY, WORDS, 25))
_OWN = lambda v: f"list_transform({v}, lambda x: cast(x as double))"
query("schema_doc_knn_many", f"""with v as (select vec_id, {_OWN('embedding')} e, sqrt({_SUM(f"list_transform({_OWN('embedding')}, lambda x: x * x)")}) size from embeddings),
 q as (select vec_id question_id, e, size, case when vec_id % 100 = 0 then ['the', 'data'] else ['er'] end words from v where vec_id % 50 = 0),
 s as (select question_id, doc_id, round(0.7::double * ({_SUM('list_transform(list_zip(q.e, v.e), lambda p: p[1] * p[2])')} / (q.size * v.size))
  + (1 - 0.7::double) * (cast(len(list_filter(words, lambda w: contains(lower(text), w))) as double) / len(words)), 6) score from documents join v on v.vec_id = doc_id cross join q)
 select * from (select question_id, cast(row_number() over (partition by question_id order by score desc, doc_id) as integer) place, doc_id, score from s) where place <= 10""")(
    lambda b: R.top_matches_many(
        b.t("documents").select("doc_id", "text").join(b.t("embeddings").select("vec_id", "embedding"), F.col("vec_id") == F.col("doc_id")),
        b.t("embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("question_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
                                                          F.when(F.col("vec_id") % 100 == 0, F.array(F.lit("the"), F.lit("data"))).otherwise(F.array(F.lit("er"))).alias("words")), 10))
_PC = lambda t, c, typ, e: f"select '{c}' column_name, '{typ}' data_type, count(*) as \"rows\", count(*) - count({c}) nulls, count(distinct {e}) distinct_values, min({e}) min_text, max({e}) max_text from {t}"
query("column_profile", " union all ".join([
    _PC("customer", "c_custkey", "bigint", "cast(c_custkey as varchar)"), _PC("customer", "c_name", "string", "c_name"), _PC("customer", "c_nationkey", "CN", "cast(c_nationkey as varchar)"),
    _PC("customer", "c_acctbal", "double", "cast(cast(c_acctbal as decimal(18,2)) as varchar)"), _PC("customer", "c_mktsegment", "string", "c_mktsegment")]).replace("'CN'", "(select case when max(typeof(c_nationkey)) = 'BIGINT' then 'bigint' else 'int' end from customer)"))(
    lambda b: R.column_profile(b.t("customer")))
