"""Incremental versions of batch jobs; results are compared with the batch answer."""

from pyspark.sql import functions as F

from ..functions.money import amount
from ..functions.periods import period_of_date
from ..functions.text import fingerprint, parse_comma_decimal
from ..operators import anomaly, fx
from ..plans import constants as K
from ..sources import files
from ..streaming import jobs as J
from .oracle_tables import TABLES, dec, times
from .registry import query
from .source_queries import EXPORT, export_csv

n = lambda: F.count("*").alias("n")  # built when a query runs: the registry loads without a session
#: Rows of a landed file, and files that a batch takes at least: several batches even for small tables.
EVENTS, POSTINGS, ALERTS, FILES = 2_000, 400_000, 5_000, 2


def event_stream(b):
    log = b.access_log
    return J.read_backlog(b.spark, J.land(log, "events", EVENTS), log.schema, FILES)


def posting_stream(b):
    rows = b.ledger().select("transaction_id", "entity_key", "entity_code", "account_code", "net", "posting_date", "ingestion_date", "period_key", "currency_code")
    return J.read_backlog(b.spark, J.land(rows, "postings", POSTINGS), rows.schema, FILES)


def bronze(b):
    path = export_csv(b)
    raw = b.spark.readStream.schema(files.text_schema(EXPORT)).options(sep=";", header=True, quote='"', escape="\\", nullValue="", maxFilesPerTrigger=J.files_a_batch(b.spark, path, FILES)).csv(path)
    typed = raw.select("transaction_id", "company_id", F.to_date("posting_date").alias("posting_date"), parse_comma_decimal("debit_amount").alias("debit"),
                       F.col("_metadata.file_name").alias("file_name"))
    return J.append_table(typed, "bronze")


query("stream_bronze_ingest", f"select seller_code company_id, period_key, count(*) n, {dec('sum(a_sale)')} debit from base_lines group by all")(
    lambda b: bronze(b).groupBy("company_id", period_of_date("posting_date").alias("period_key")).agg(n(), F.sum("debit").alias("debit")))


def deduped(b):
    s = event_stream(b).withColumn("fp", fingerprint("user_id", "action", F.to_date("event_ts")))
    return J.dedupe_table(s, "deduped", "event_ts", ["fp"])


query("stream_dedupe", "select user_id, action, count(distinct cast(event_ts as date)) n, min(event_ts) first_ts from accesslog group by all")(
    lambda b: deduped(b).groupBy("user_id", "action").agg(n(), F.min("event_ts").alias("first_ts")))
query("stream_tumbling_velocity", f"select posting_date window_day, account_code, count(*) n from gl group by all having count(*) > {anomaly.VELOCITY_LIMIT}")(
    lambda b: J.tumbling_counts(posting_stream(b).withColumn("ts", F.col("posting_date").cast("timestamp")), "velocity", "ts", ["account_code"], "1 day").where(
        F.col("n") > anomaly.VELOCITY_LIMIT).select(F.to_date("window_start").alias("window_day"), "account_code", "n"))
query("stream_hourly_velocity", "select cast(event_ts as date) d, cast(hour(event_ts) as integer) h, action, count(*) n from accesslog group by all having count(*) > 2")(
    lambda b: J.tumbling_counts(event_stream(b), "hourly", "event_ts", ["action"], "1 hour").where("n > 2").select(
        F.to_date("window_start").alias("d"), F.hour("window_start").alias("h"), "action", "n"))
query("stream_sliding_activity", "select cast(cast(event_ts as date) - cast(k as integer) as date) window_day, user_id, action, count(*) n from accesslog, unnest([0, 1, 2, 3, 4, 5, 6]) t(k) group by all")(
    lambda b: J.sliding_counts(event_stream(b), "sliding", "event_ts", ["user_id", "action"], "7 days", "1 day").select(
        F.to_date("window_start").alias("window_day"), "user_id", "action", "n"))
query("stream_session_activity", """select user_id, count(*) n, (epoch_us(max(event_ts)) - epoch_us(min(event_ts))) // 1000000 + 1800 duration_s, cast(min(event_ts) as date) d from (
 select *, sum(brk) over (partition by user_id order by event_ts, event_id) sid from (select *, case when event_ts - lag(event_ts) over (partition by user_id order by event_ts, event_id) < interval 30 minute then 0 else 1 end brk from accesslog))
 group by user_id, sid""")(
    lambda b: J.sessions(event_stream(b), "sessions", "event_ts", ["user_id"], "30 minutes").select(
        "user_id", "n", F.expr("(unix_micros(session_end) - unix_micros(session_start)) DIV 1000000").alias("duration_s"), F.to_date("session_start").alias("d")))


def late_split(b):
    s = posting_stream(b).withColumn("is_late", F.date_diff("ingestion_date", F.last_day("posting_date")) > K.LATE_AFTER_DAYS)
    return J.append_table(s, "late-split", ["is_late"])


query("stream_late_split", f"select date_diff('day', last_day(posting_date), ingestion_date) > 5 is_late, period_key, count(*) n, {dec('sum(net)')} net from gl group by all")(
    lambda b: late_split(b).groupBy("is_late", "period_key").agg(n(), F.sum("net").alias("net")))


def incremental_fact(b):
    """Postings and corrections of them, in files of any order: a correction has a later version, and some move to another month."""
    p = b.ledger().select("transaction_id", "entity_key", "account_code", "net", "period_key", F.lit(0).alias("version"))
    moved = p.where("entity_key % 4 = 1 AND period_key = 199906").withColumns({"period_key": F.lit(199908), "version": F.lit(2)})
    fixed = p.where("entity_key % 2 = 1 AND period_key = 199906").withColumns({"net": amount(F.col("net") + 1), "version": F.lit(1)})
    rows = p.unionByName(moved).unionByName(fixed)
    s = J.read_backlog(b.spark, J.land(rows, "corrected", POSTINGS), rows.schema, FILES)
    return J.merge_table(s, "fact", ["transaction_id"], "period_key", ["entity_key", "account_code"], ["version"])


query("stream_incremental_fact", f"""with p as (select transaction_id, entity_key, account_code, net, period_key, 0 version from gl), r as (select * from p
 union all select * replace (199908 as period_key, 2 as version) from p where entity_key % 4 = 1 and period_key = 199906 union all select * replace (net + 1 as net, 1 as version) from p where entity_key % 2 = 1 and period_key = 199906),
 u as (select *, row_number() over (partition by transaction_id order by version desc, entity_key desc, account_code desc, net desc, period_key desc) place from r)
 select cast(period_key as integer) period_key, account_code, count(distinct transaction_id) n, {dec('sum(net)')} net from u where place = 1 group by all""")(
    lambda b: incremental_fact(b).groupBy("period_key", "account_code").agg(F.countDistinct("transaction_id").alias("n"), F.sum("net").alias("net")))


def enriched(b):
    """Posting stream against the static account plan and the static daily rates."""
    s = posting_stream(b).join(b.accounts.select("account_code", "l1_category"), "account_code", "left")
    return J.append_table(fx.fcy_to_huf(s, b.fx_daily, "net"), "enriched")


query("stream_static_enrich", f"""select s.currency_code, l1_category, period_key, count(*) n, {dec('sum(h)')} amount_huf from (select g.currency_code, period_key, l1_category,
 case when g.currency_code = 'HUF' then net else {times('net', 'coalesce(d.rate_to_huf, 1)')} end h from gl g left join coa a on a.account_code = g.account_code
 left join fxday d on d.currency_code = g.currency_code and d."day" = posting_date) s group by all""")(
    lambda b: enriched(b).groupBy("currency_code", "l1_category", "period_key").agg(n(), F.sum("amount_huf").alias("amount_huf")))


RULE = K.rule("LARGE_SALE_LINE")


def cooled(b):
    large = b.base().where(F.col("a_sale") > RULE["threshold_value"]).select(
        F.lit(RULE["rule_code"]).alias("rule_code"), F.col("seller_code").alias("entity_code"),
        (F.col("posting_date").cast("timestamp") + F.make_dt_interval(hours=(F.col("partkey") % 24).cast("int"), mins=(F.col("suppkey") % 60).cast("int"))).alias("raised_at"))
    return J.cooldown_table(J.read_backlog(b.spark, J.land(large, "alerts", ALERTS), large.schema, FILES), "candidates", RULE["cooldown_hours"])


query("stream_alert_cooldown", f"""with recursive a as (select seller_code entity_code, posting_date + to_hours(cast(partkey % 24 as integer)) + to_minutes(cast(suppkey % 60 as integer)) raised_at from base_lines where a_sale > {RULE["threshold_value"]}),
 fired as (select entity_code, min(raised_at) t from a group by all union all
 select f.entity_code, min(l.raised_at) from fired f join a l on l.entity_code = f.entity_code and l.raised_at >= f.t + interval {RULE["cooldown_hours"]} hour group by f.entity_code, f.t)
 select '{RULE["rule_code"]}' rule_code, entity_code, cast(t as date) fired_on, cast(hour(t) as integer) fired_hour, cast(minute(t) as integer) fired_minute from fired""")(
    lambda b: cooled(b).select("rule_code", "entity_code", F.to_date("raised_at").alias("fired_on"), F.hour("raised_at").alias("fired_hour"), F.minute("raised_at").alias("fired_minute")))
