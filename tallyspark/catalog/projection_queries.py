"""Staging, derived columns, period arithmetic, formats and scalar functions.

Row-level operators run over the whole ledger; their result is shown as counts, sums and hash folds per group.
"""

from pyspark.sql import functions as F

from ..functions import periods as P, sqlfuncs, text as T
from ..functions.money import rnd
from ..operators import accounts as acc, staging as S
from ..plans import constants as K
from ..session import cut_lineage
from .oracle_tables import TABLES, dec
from .registry import query

n = lambda: F.count("*").alias("n")  # built when a query runs: the registry loads without a session
count_if = lambda c, name: F.count(F.when(c, 1)).alias(name)
hash_fold = lambda c, name: F.bit_xor(F.conv(F.substring(c, 1, 12), 16, 10).cast("bigint")).alias(name)
sql_fold = lambda e: f"bit_xor(cast('0x' || substr({e}, 1, 12) as bigint))"

TABLES["bronze"] = """select * replace (case when partkey % 101 <> 0 then entity_code end as entity_code, case when partkey % 103 <> 0 then account_code end as account_code) from gl"""
TABLES["staged"] = """select b.*, period_key // 100 period_year, c.account_code is null is_unmapped_account,
 posting_date < date '2001-12-26' and period_key // 100 < 2001 is_late_entry,
 sha256(entity_code || '|' || b.account_code || '|' || cast(posting_date as varchar) || '|' || document_number || '|' || cast(debit as varchar) || '|' || cast(credit as varchar)) row_hash
 from bronze b left join coa c on b.account_code = c.account_code where entity_code is not null and b.account_code is not null"""


def staged(b):
    return S.stage_gl(S.bronze_ledger(b.ledger(on_lines=S.line_texts)), b.accounts)


query("stage_gl", f"""select entity_code, period_key, count(*) n, {dec('sum(debit)')} debit, {dec('sum(net)')} net, {dec('sum(debit_fcy)')} debit_fcy, count(case when is_unmapped_account then 1 end) unmapped,
 count(case when is_late_entry then 1 end) late, count(case when is_intercompany then 1 end) ic, {sql_fold('row_hash')} hash_fold, max(ingestion_date) last_ingested from staged group by all""")(
    lambda b: staged(b).groupBy("entity_code", "period_key").agg(
        n(), F.sum("debit").alias("debit"), F.sum("net").alias("net"), F.sum("debit_fcy").alias("debit_fcy"), count_if(F.col("is_unmapped_account"), "unmapped"),
        count_if(F.col("is_late_entry"), "late"), count_if(F.col("is_intercompany"), "ic"), hash_fold("row_hash", "hash_fold"),
        F.max("ingestion_date").alias("last_ingested")))
query("stage_balance_sheet", "select entity_key, period_year, period_month, cast(period_key as integer) period_key, account_code, account_class, normal_balance, closing_balance, opening_balance from bs_stage")(
    lambda b: S.stage_balance_sheet(b.balance_upload))
query("stage_budget", "select entity_key, period_key, account_code, budget_version, budget_amount from bud")(
    lambda b: b.budget.select("entity_key", "period_key", "account_code", "budget_version", "budget_amount"))
def fingerprints(b):
    """Folds and the number of different fingerprints per month.

    Rows are counted by the first 48 bits of their digests, which also make the fold. Where these bits stand alone they are one fingerprint; whole
    digests are compared only where bits repeat, and at a month's ends for the smallest and the largest.
    """
    rows = staged(b).select("period_key", "row_hash", F.conv(F.substring("row_hash", 1, 12), 16, 10).cast("bigint").alias("head"))
    heads = cut_lineage(rows.groupBy("period_key", "head").agg(n()), "fingerprint-heads")
    months = heads.groupBy("period_key").agg(
        F.bit_xor(F.when(F.col("n") % 2 == 1, F.col("head")).otherwise(0)).alias("hash_fold"), F.count("*").alias("heads"),
        F.min("head").alias("first"), F.max("head").alias("last"))
    shared = heads.where("n > 1").select("period_key", "head")
    ends = months.select("period_key", F.explode(F.array("first", "last")).alias("head"))
    looked_at = cut_lineage(shared.unionByName(ends).distinct(), "fingerprint-shared")
    looked_at = looked_at.select(F.col("period_key").alias("_p"), F.col("head").alias("_head"))
    whole = rows.join(looked_at, F.col("period_key").eqNullSafe(F.col("_p")) & (F.col("head") == F.col("_head")), "left_semi").groupBy("period_key", "head", "row_hash").agg(n())
    exact = whole.groupBy(F.col("period_key").alias("_p")).agg(F.max("row_hash").alias("max_hash"), F.min("row_hash").alias("min_hash"), F.count("*").alias("digests"),
                                            F.countDistinct("head").alias("seen"))
    return months.join(exact, F.col("period_key").eqNullSafe(F.col("_p"))).select("period_key", "hash_fold", "max_hash", "min_hash", (F.col("heads") - F.col("seen") + F.col("digests")).alias("hashes"))


query("row_fingerprint", f"""select period_key, {sql_fold('row_hash')} hash_fold, max(row_hash) max_hash, min(row_hash) min_hash, count(distinct row_hash) hashes from staged group by all""")(
    fingerprints)
query("flag_unmapped_account", f"""select entity_key, account_code, account_code not in (select account_code from coa) is_unmapped_account, count(*) n, {dec('sum(net)')} net from gl group by all""")(
    lambda b: S.flag_unmapped(b.ledger(), b.accounts).groupBy("entity_key", "account_code", "is_unmapped_account").agg(n(), F.sum("net").alias("net")))
query("late_flag_relative", "select period_key, posting_date < date '2001-12-26' and period_key // 100 < 2001 is_late_entry, count(*) n from gl group by all")(
    lambda b: b.ledger().withColumn("period_year", F.floor(F.col("period_key") / 100)).withColumn(
        "is_late_entry", S.is_late_relative("posting_date", "period_year", K.AS_OF)).groupBy("period_key", "is_late_entry").agg(n()))
query("late_flag_closed_period", """with cal as (select distinct entity_key, period_key, period_key < 200101 - (entity_key % 2) * 100 is_closed from tb)
 select g.entity_key, g.period_key, coalesce(is_closed, false) is_late_closed, count(*) n from gl g left join cal c on c.entity_key = g.entity_key and c.period_key = year(document_date) * 100 + month(document_date) group by all""")(
    lambda b: S.flag_late_closed_period(b.ledger(), b.calendar).groupBy("entity_key", "period_key", "is_late_closed").agg(n()))
query("late_flag_ingestion_lag", """select entity_key, period_key, count(case when date_diff('day', last_day(posting_date), ingestion_date) > 5 then 1 end) late, cast(max(date_diff('day', last_day(posting_date), ingestion_date)) as integer) max_lag from gl group by all""")(
    lambda b: b.ledger().groupBy("entity_key", "period_key").agg(count_if(S.ingestion_lag_days() > K.LATE_AFTER_DAYS, "late"), F.max(S.ingestion_lag_days()).alias("max_lag")))
query("signed_amount", f"""select entity_key, g.account_code, account_type, {dec("sum(case when account_type = 'Revenue' then credit - debit else debit - credit end)")} signed, count(*) n
 from gl g join coa c on g.account_code = c.account_code group by all""")(
    lambda b: acc.map_accounts(b.ledger(), b.accounts).groupBy("entity_key", "account_code", "account_type").agg(F.sum("signed").alias("signed"), n()))
query("signed_balance", f"""select entity_key, cast(period_key as integer) period_key, account_code, {dec("case when normal_balance = 'C' then -closing_balance else closing_balance end")} signed_balance from bs_stage""")(
    lambda b: S.stage_balance_sheet(b.balance_upload).select("entity_key", "period_key", "account_code", S.signed_balance("closing_balance", "normal_balance").alias("signed_balance")))
query("account_path_levels", f"""select period_key, level_1, level_2, level_3, level_4, {dec('sum(net)')} net, {dec("sum(case when universal_node like 'ASSET.CURRENT%' then net else 0 end)")} current_assets from (
 select *, split_part(universal_node, '.', 1) level_1, nullif(split_part(universal_node, '.', 2), '') level_2, nullif(split_part(universal_node, '.', 3), '') level_3, nullif(split_part(universal_node, '.', 4), '') level_4 from tbm) group by all""")(
    lambda b: b.mapped.withColumns(acc.account_levels()).groupBy("period_key", "level_1", "level_2", "level_3", "level_4").agg(
        F.sum("net").alias("net"), F.sum(F.when(acc.under("ASSET.CURRENT"), F.col("net")).otherwise(0)).alias("current_assets")))


def amount_in(currency="HUF"):
    """Reporting amount column by currency; anything but EUR means the home currency."""
    return F.col("net_eur" if currency.upper() == "EUR" else "net")


query("multi_currency_select", f"select entity_key, {dec('sum(net)')} amount_huf, {dec('sum(net_eur)')} amount_eur, {dec('sum(net)')} amount_default from tb group by all")(
    lambda b: b.trial_balance.groupBy("entity_key").agg(F.sum(amount_in("HUF")).alias("amount_huf"), F.sum(amount_in("EUR")).alias("amount_eur"), F.sum(amount_in()).alias("amount_default")))

# ---- periods over the order dates -----------------------------------------------------------------------------
orders = lambda b: b.t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("d")).withColumn("p", P.period_of_date("d"))
O = "from (select o_orderkey, cast(o_orderdate as date) d, cast(year(o_orderdate) * 100 + month(o_orderdate) as integer) p from orders)"


def period_query(key, sql, *cols):
    query(key, f"select o_orderkey, {sql} {O}")(lambda b: orders(b).select("o_orderkey", *[make().alias(name) for name, make in cols]))


period_query("period_key_of", "p period_key", ("period_key", lambda: P.period_key_of(F.year("d"), F.month("d"))))
_FY = lambda m: f"cast(year(d) - case when month(d) < {m} then 1 else 0 end as integer)"
_FP = lambda m: f"(month(d) - {m} + 12) % 12 + 1"
period_query("fiscal_year_of", ", ".join(f"{_FY(m)} fy_{m}" for m in (1, 4, 10)), *[(f"fy_{m}", lambda m=m: P.fiscal_year_of("d", m)) for m in (1, 4, 10)])
period_query("fiscal_period_of", ", ".join(f"cast({_FP(m)} as integer) fp_{m}" for m in (1, 4, 10)), *[(f"fp_{m}", lambda m=m: P.fiscal_period_of("d", m)) for m in (1, 4, 10)])
period_query("fiscal_quarter_of", ", ".join(f"cast(ceil(({_FP(m)}) / 3.0) as integer) fq_{m}" for m in (1, 4, 10)), *[(f"fq_{m}", lambda m=m: P.fiscal_quarter_of("d", m)) for m in (1, 4, 10)])
period_query("prior_period_key", "case when p % 100 = 1 then p - 89 else p - 1 end prior_period_key", ("prior_period_key", lambda: P.prior_period_key("p")))
period_query("prior_year_key", "p - 100 prior_year_key", ("prior_year_key", lambda: P.prior_year_key("p")))
_ADD = lambda k: f"cast(year(d + interval '{k} month') * 100 + month(d + interval '{k} month') as integer)"
period_query("period_add", f"{_ADD(5)} plus_5, {_ADD(-24)} minus_24, {_ADD(-1)} minus_1", ("plus_5", lambda: P.period_add("p", 5)), ("minus_24", lambda: P.period_add("p", -24)), ("minus_1", lambda: P.period_add("p", -1)))
period_query("period_end_date", "last_day(d) period_end", ("period_end", lambda: P.period_end_date("p")))
period_query("period_label", "strftime(d, '%B %Y') period_label", ("period_label", lambda: P.period_label("p")))
query("fiscal_year_filter", f"select o_orderkey, p period_key {O} where d >= date '1998-04-01' and d < date '1999-04-01'")(
    lambda b: orders(b).where(P.in_fiscal_year("p", 1998, 4)).select("o_orderkey", F.col("p").alias("period_key")))
query("validate_period_key", f"select o_orderkey, k, k between 200001 and 209912 and k % 100 between 1 and 12 is_valid from (select o_orderkey, p + cast(o_orderkey % 15 as integer) k {O})")(
    lambda b: orders(b).withColumn("k", (F.col("p") + F.col("o_orderkey") % 15).cast("int")).select("o_orderkey", "k", P.is_valid_period("k").alias("is_valid")))
_MD5 = "md5(cast(event_id as varchar))"
query("validate_uuid", f"""select event_id, regexp_full_match(u, '[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}') is_valid from (select event_id,
 case when event_id % 3 = 0 then {_MD5} else substr({_MD5}, 1, 8) || '-' || substr({_MD5}, 9, 4) || '-' || substr({_MD5}, 13, 4) || '-' || substr({_MD5}, 17, 4) || '-' || substr({_MD5}, 21, 12) || case when event_id % 5 = 0 then 'x' else '' end end u from events)""")(
    lambda b: b.t("events").withColumn("m", F.md5(F.col("event_id").cast("string"))).withColumn("u", F.when(F.col("event_id") % 3 == 0, F.col("m")).otherwise(F.concat(
        F.concat_ws("-", *[F.substring("m", s, l) for s, l in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.when(F.col("event_id") % 5 == 0, "x").otherwise("")))
    ).select("event_id", T.is_uuid("u").alias("is_valid")))
query("validate_entity_code", """select c_custkey, regexp_full_match(case when c_custkey % 2 = 0 then c_name else c_mktsegment end, '[A-Za-z0-9_\\-]{1,50}') is_valid from customer""")(
    lambda b: b.t("customer").select("c_custkey", T.is_entity_code(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(F.col("c_mktsegment"))).alias("is_valid")))

# ---- formats --------------------------------------------------------------------------------------------------
query("format_amounts", """select period_key, entity_key, consolidation_scope, printf('%.1fM HUF', round(cast(revenue as double) / 1e6 * (1 + 1e-12), 1) + 0) revenue_text, case when revenue_yoy_pct is not null then printf('%.1f%%', round(revenue_yoy_pct * (1 + 1e-12), 1) + 0) end yoy_text,
 printf('%.2fx', round(gross_margin_pct / 10 * (1 + 1e-12), 2)) multiple_text, printf('%.0f days', round(abs(gross_margin_pct) * 3 * (1 + 1e-12), 0)) days_text from t_pl""")(
    lambda b: b.pl.select("period_key", "entity_key", "consolidation_scope", T.shown("revenue", T.fmt_millions("revenue")).alias("revenue_text"),
                          T.shown("revenue_yoy_pct", T.fmt_percent("revenue_yoy_pct")).alias("yoy_text"), T.fmt_multiple(F.col("gross_margin_pct") / 10).alias("multiple_text"),
                          T.fmt_days(F.abs("gross_margin_pct") * 3).alias("days_text")))
query("materiality_flag", "select period_key, entity_key, consolidation_scope, coalesce(abs(revenue_yoy_pct) >= 5, false) yoy_material, coalesce(abs(revenue_variance_pct) >= 5, false) budget_material from t_pl")(
    lambda b: b.pl.select("period_key", "entity_key", "consolidation_scope", T.is_material("revenue_yoy_pct").alias("yoy_material"), T.is_material("revenue_variance_pct").alias("budget_material")))

# ---- scalar families ------------------------------------------------------------------------------------------
query("scalar_string", """select doc_id, upper(left(source, 3)) || '-' || right('000000' || cast(doc_id as varchar), 6) code, trim(lower(lang)) lang, source like 'w%' starts_w, source not like '%a%' no_a,
 text ~ '[0-9]' has_digit, len(string_split(trim(regexp_replace(text, '[ \\t\\n\\r]+', ' ', 'g')), ' ')) words from documents""")(
    lambda b: b.t("documents").select(
        "doc_id", F.concat(F.upper(F.left("source", F.lit(3))), F.lit("-"), F.right(F.concat(F.lit("000000"), F.col("doc_id").cast("string")), F.lit(6))).alias("code"),
        F.trim(F.lower("lang")).alias("lang"), F.col("source").like("w%").alias("starts_w"), (~F.col("source").like("%a%")).alias("no_a"), F.col("text").rlike("[0-9]").alias("has_digit"),
        F.size(F.split(F.trim(F.regexp_replace("text", "[ \\t\\n\\r]+", " ")), " ")).cast("long").alias("words")))
query("scalar_date", """select event_id, cast(ts as date) d, cast(year(ts) as integer) y, cast(month(ts) as integer) m, cast(hour(ts) as integer) h, cast(cast(ts as date) + 5 as date) plus_5, cast(date_diff('day', cast(ts as date), last_day(ts)) as integer) days_left,
 last_day(ts) month_end, make_date(year(ts), month(ts), 1) month_start, cast(epoch(date_trunc('second', ts)) as bigint) epoch_s, cast(ts + interval '36 hours' as date) later from events""")(
    lambda b: b.access_log.select(
        "event_id", F.to_date("event_ts").alias("d"), F.year("event_ts").alias("y"), F.month("event_ts").alias("m"), F.hour("event_ts").alias("h"), F.date_add(F.to_date("event_ts"), 5).alias("plus_5"),
        F.date_diff(F.last_day("event_ts"), F.to_date("event_ts")).alias("days_left"), F.last_day("event_ts").alias("month_end"), F.make_date(F.year("event_ts"), F.month("event_ts"), F.lit(1)).alias("month_start"),
        F.unix_timestamp("event_ts").alias("epoch_s"), F.to_date(F.col("event_ts") + F.expr("INTERVAL '36' HOUR")).alias("later")))
query("scalar_math", """select c_custkey, abs(c_acctbal) a, round(c_acctbal * (1 + 1e-12), 1) r, cast(ceil(c_acctbal / 7) as bigint) c, cast(c_custkey % 7 as bigint) m, c_custkey // 4 q, nullif(c_nationkey, 3) nn, case when c_nationkey <> 0 then round(c_acctbal / c_nationkey * (1 + 1e-12), 4) end safe_div from customer""")(
    lambda b: b.t("customer").select("c_custkey", F.abs("c_acctbal").alias("a"), rnd("c_acctbal", 1).alias("r"), F.ceil(F.col("c_acctbal") / 7).alias("c"), (F.col("c_custkey") % 7).alias("m"),
                                     F.expr("c_custkey div 4").alias("q"), F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nn"),
                                     rnd(F.try_divide(F.col("c_acctbal"), F.col("c_nationkey")), 4).alias("safe_div")))
query("scalar_json", """select event_id, cast(json_extract(props, '$.k') as integer) k, '{"user_id":' || user_id || ',"action":"' || event_type || '","k":' || json_extract(props, '$.k') || '}' detail from events""")(
    lambda b: b.access_log.withColumn("p", F.from_json("props", "k INT")).select("event_id", F.col("p.k").alias("k"), F.to_json(F.struct("user_id", "action", F.col("p.k").alias("k"))).alias("detail")))
query("sql_functions", f"select o_orderkey, cast(p % 100 as integer) month_no, case when p % 100 = 1 then p - 89 else p - 1 end prior_period, last_day(d) period_end, p between 200001 and 209912 and p % 100 between 1 and 12 is_valid {O}")(
    lambda b: (sqlfuncs.register_sql(b.spark), orders(b).selectExpr(
        "o_orderkey", "p % 100 AS month_no", "tally_prior_period(p) AS prior_period", "tally_period_end(p) AS period_end", "tally_valid_period(p) AS is_valid"))[1])
query("parse_comma_decimal", f"""select period_key, {dec('sum(debit)')} debit, count(case when partkey % 89 = 0 then 1 end) unreadable, count(*) n from (select * replace (case when partkey % 89 <> 0 then debit end as debit) from gl) group by all""")(
    lambda b: b.ledger().withColumn("txt", F.when(F.col("partkey") % 89 == 0, F.lit("n/a")).otherwise(F.translate(F.col("debit").cast("string"), ".", ",")))
    .withColumn("parsed", T.parse_comma_decimal("txt")).groupBy("period_key").agg(F.sum("parsed").alias("debit"), count_if(F.col("parsed").isNull(), "unreadable"), n()))
