"""Scans, manifests and sinks. Files are written from the books to the shared folder and read back."""

import time
from functools import reduce

from pyspark.sql import functions as F

from ..functions.money import amount
from ..operators import fx as fx_ops, windows as W
from ..plans import constants as K
from ..session import fresh_path
from ..sources import files as S, manifest as M, sinks
from .oracle_tables import TABLES, dec
from .registry import query

n = lambda: F.count("*").alias("n")  # built when a query runs: the registry loads without a session
MONEY = S.MONEY
EXPORT = ["transaction_id", "company_id", "local_account_code", "posting_date", "document_number", "debit_amount", "credit_amount", "currency_code", "description"]


def comma(c):
    return F.translate(F.col(c).cast("string"), ".", ",")


def sales(b):
    """One sales posting per order line, with its home currency text."""
    return b.base().select(
        F.concat_ws("-", "orderkey", "linenumber").alias("source_id"), F.col("seller_code").alias("company"), "posting_date", "period_key",
        F.col("orderkey").cast("string").alias("document_number"), F.col("a_sale").alias("debit"), F.lit(0).cast("decimal(18,2)").alias("credit"),
        "is_intercompany", "suppkey", "partkey", "returnflag", F.col("a_other").alias("tax_part"))


TABLES["sale_rows"] = """select cast(orderkey as varchar) || '-' || cast(linenumber as varchar) source_id, seller_code company, seller_key, posting_date, period_key, cast(orderkey as varchar) document_number,
 a_sale debit, is_intercompany, suppkey, partkey, returnflag, coalesce(a_other, a_unmapped) vat from base_lines"""


def export_csv(b, rows=None, path=None):
    """ERP text export: semicolons, comma decimals, quoted text with separators inside, empty fields."""
    path = path or fresh_path(b.spark, "erp-csv")
    out = (sales(b) if rows is None else rows).select(
        F.col("source_id").alias("transaction_id"), F.col("company").alias("company_id"), F.lit("311").alias("local_account_code"),
        F.date_format("posting_date", "yyyy-MM-dd").alias("posting_date"), "document_number", comma("debit").alias("debit_amount"),
        comma("credit").alias("credit_amount"), F.lit("HUF").alias("currency_code"),
        F.when(F.col("partkey") % 2 == 0, F.concat(F.lit('sale; "order" '), "document_number")).alias("description"))
    S.write_delimited(out, path)
    return path


query("scan_delimited", f"""select company company_id, {dec('sum(debit)')} debit, count(*) n, count(case when partkey % 2 = 0 then 1 end) described, max(posting_date) last_posting,
 min(case when partkey % 2 = 0 then 'sale; "order" ' || document_number end) first_text from sale_rows group by all""")(
    lambda b: S.read_delimited(b.spark, export_csv(b), EXPORT).groupBy("company_id").agg(
        F.sum(S.parse_comma_decimal("debit_amount")).alias("debit"), n(), F.count("description").alias("described"),
        F.max(F.to_date("posting_date")).alias("last_posting"), F.min("description").alias("first_text")))


def export_partitioned(b):
    path = fresh_path(b.spark, "landing")
    groups = b.entities.select(F.col("entity_code").alias("company"), F.col("consolidation_group").alias("entity"))
    out = sales(b).join(groups, "company").select("source_id", comma("debit").alias("debit_amount"), "entity",
                                                  F.year("posting_date").alias("year"), F.month("posting_date").alias("month"))
    (out.hint("rebalance", "entity", "year", "month").write.partitionBy("entity", "year", "month")
     .options(sep=";", header=True, maxRecordsPerFile=1_000_000).csv(path))
    return path


query("scan_partition_path", f"select consolidation_group entity, cast(year(posting_date) as integer) \"year\", cast(month(posting_date) as integer) \"month\", count(*) n, {dec('sum(debit)')} debit from sale_rows join ents on entity_code = company group by all")(
    lambda b: S.with_path_columns(S.read_delimited(b.spark, export_partitioned(b), ["source_id", "debit_amount"])).groupBy("entity", "year", "month").agg(
        n(), F.sum(S.parse_comma_decimal("debit_amount")).alias("debit")))


def modified_since(b):
    """Two exports into one folder, a moment apart; only the files of the second are read."""
    rows = sales(b)
    path = export_csv(b, rows.where("posting_date < '1998-01-01'"))
    first = M.scan_files(b.spark, path).agg(F.date_format(F.max("modificationTime") + F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    time.sleep(2.1)  # the cut-off has whole seconds
    export_csv(b, rows.where("posting_date >= '1998-01-01'"), path)
    return S.read_since(b.spark, path, EXPORT, first).groupBy("company_id").agg(n(), F.sum(S.parse_comma_decimal("debit_amount")).alias("debit"))


query("scan_modified_since", f"select company company_id, count(*) n, {dec('sum(debit)')} debit from sale_rows where posting_date >= date '1998-01-01' group by all")(modified_since)


PAGES, INVOICES = 100_000, 200_000  # rows of a written file that one task reads


def journals(b):
    """One journal per order line; its legs are the nested lines, so a document is bounded by the posting templates."""
    path = fresh_path(b.spark, "journals")
    ic = F.col("is_intercompany")
    line = lambda no, account, deb, cre: F.struct(F.lit(no).alias("LineNum"), account.alias("AccountCode"), deb.cast("string").alias("Debit"),
                                                  cre.cast("string").alias("Credit"), F.when(F.col("partkey") % 3 == 0, "EUR").alias("FCCurrency"),
                                                  F.when(F.col("partkey") % 3 == 0, (deb.cast(MONEY) * 2).cast(MONEY).cast("string")).alias("FCDebit"),
                                                  F.when(F.col("partkey") % 3 == 0, (cre.cast(MONEY) * 2).cast(MONEY).cast("string")).alias("FCCredit"),
                                                  F.when(F.col("partkey") % 7 != 0, F.concat(F.lit("CC"), (F.col("partkey") % 50).cast("string"))).alias("CostingCode"),
                                                  F.when(F.col("suppkey") % 5 != 0, F.concat(F.lit("P"), (F.col("suppkey") % 20).cast("string"))).alias("ProjectCode"),
                                                  F.concat(F.lit("line "), F.lit(no)).alias("LineMemo"))
    zero = F.lit("0.00")
    lines = []
    for i, (leg, _, d, c, d_ic, c_ic, a) in enumerate(K.LEGS):
        lines += [F.when(F.col(a).isNotNull(), line(2 * i, F.when(ic, d_ic).otherwise(d), F.col(a), zero)),
                  F.when(F.col(a).isNotNull(), line(2 * i + 1, F.when(ic, c_ic).otherwise(c), zero, F.col(a)))]
    journal = F.struct(F.col("orderkey").alias("JdtNum"), F.concat_ws("-", "orderkey", "linenumber").alias("TransId"),
                       F.col("posting_date").cast("string").alias("ReferenceDate"), F.date_add("posting_date", 30).cast("string").alias("DueDate"),
                       F.concat(F.lit("order "), F.col("orderkey")).alias("Memo"), F.col("returnflag").alias("TransactionCode"),
                       F.filter(F.array(*lines), lambda x: x.isNotNull()).alias("lines"))
    # a page's texts repeat, so it takes a fraction of its room when compressed; such a file is read by one task, hence the bound on its pages
    b.base().select(F.array(journal).alias("value")).write.options(maxRecordsPerFile=PAGES, compression="gzip").json(path)
    return S.read_journals(b.spark, path)


query("scan_json_journal", f"""select account_code, year(posting_date) * 100 + month(posting_date) period, count(*) n, {dec('sum(debit)')} debit, {dec('sum(credit)')} credit, count(case when partkey % 3 = 0 then 1 end) foreign_lines,
 {dec('coalesce(sum(case when partkey % 3 = 0 then 2 * (debit + credit) end), 0)')} fcy, count(distinct case when partkey % 7 <> 0 then partkey % 50 end) centres, max(case when cast(split_part(transaction_id, '-', 4) as bigint) % 5 <> 0 then 'P' || (cast(split_part(transaction_id, '-', 4) as bigint) % 20) end) last_project,
 max(posting_date + 30) last_due, max('order ' || split_part(source_id, '-', 1)) last_memo from gl group by all""")(
    lambda b: journals(b).groupBy("account_code", (F.year("reference_date") * 100 + F.month("reference_date")).cast("long").alias("period")).agg(
        n(), F.sum("debit").alias("debit"), F.sum("credit").alias("credit"), F.count("currency_code").alias("foreign_lines"),
        F.coalesce(F.sum(F.col("debit_fcy") + F.col("credit_fcy")), F.lit(0).cast("decimal(38,2)")).alias("fcy"), F.countDistinct("cost_centre").alias("centres"), F.max("project").alias("last_project"),
        F.max("due_date").alias("last_due"), F.max("memo").alias("last_memo")))


def invoice_heads(b):
    vat = F.coalesce("a_other", "a_unmapped")
    return b.base().select(
        F.concat_ws("-", "orderkey", "linenumber").alias("invoice_no"), "posting_date", "document_date", F.col("buyer_code").alias("customer"),
        F.col("a_sale").alias("net"), vat.alias("vat"), amount(F.col("a_sale") + vat).alias("gross"),
        F.when(F.col("returnflag") == "A", "STORNO").when(F.col("returnflag") == "R", "CORRECTION").otherwise("NORMAL").alias("invoice_type"))


TABLES["inv"] = """select cast(orderkey as varchar) || '-' || cast(linenumber as varchar) invoice_no, posting_date, buyer_code customer, a_sale net, coalesce(a_other, a_unmapped) vat,
 a_sale + coalesce(a_other, a_unmapped) gross, case returnflag when 'A' then 'STORNO' when 'R' then 'CORRECTION' else 'NORMAL' end invoice_type from base_lines"""


def xml_invoices(b):
    path = fresh_path(b.spark, "invoices-xml")
    invoice_heads(b).select(
        F.col("invoice_no").alias("szamlaszam"), F.col("document_date").alias("kelte"), F.col("posting_date").alias("teljesites"), F.col("customer").alias("vevo_nev"),
        F.date_add("posting_date", 8).alias("fizetesi_hatarido"), F.concat(F.lit("1"), F.substring(F.md5("customer"), 1, 7)).alias("vevo_adoszam"), F.lit("HU").alias("vevo_orszag"),
        F.col("net").alias("netto_osszeg"), F.col("vat").alias("afa_osszeg"), F.col("gross").alias("brutto_osszeg"), F.when(F.col("invoice_type") == "NORMAL", "HUF").otherwise("EUR").alias("devizanem"),
        F.when(F.col("invoice_type") != "NORMAL", F.lit("390.25").cast("decimal(16,6)")).alias("deviza_arfolyam"), F.col("net").alias("netto_huf"), F.col("gross").alias("brutto_huf"),
        F.lit("BANK & cash").alias("fizetesi_mod"), F.col("invoice_type").alias("szamla_tipus"),
        F.when(F.col("invoice_type") != "NORMAL", F.concat(F.lit("O-"), F.col("invoice_no"))).alias("eredeti_szamlaszam")).write.format("xml").options(
            rootTag="szamlak", rowTag="szamla", maxRecordsPerFile=INVOICES, compression="lz4").save(path)
    return S.read_invoices(b.spark, path)


query("scan_xml_invoice", f"""select customer vevo_nev, invoice_type szamla_tipus, count(*) n, {dec('sum(net)')} netto, {dec('sum(vat)')} afa, {dec('sum(gross)')} brutto, max(posting_date) utolso, max(posting_date + 8) hatarido,
 '1' || substr(md5(customer), 1, 7) adoszam, case when invoice_type = 'NORMAL' then 'HUF' else 'EUR' end devizanem, cast(case when invoice_type <> 'NORMAL' then 390.25 end as decimal(38,6)) arfolyam, {dec('sum(gross)')} brutto_huf,
 max(case when invoice_type <> 'NORMAL' then 'O-' || invoice_no end) eredeti, 'BANK & cash' fizetesi_mod from inv group by all""")(
    lambda b: xml_invoices(b).groupBy("vevo_nev", "szamla_tipus").agg(n(), F.sum("netto_osszeg").alias("netto"), F.sum("afa_osszeg").alias("afa"),
                                                                     F.sum("brutto_osszeg").alias("brutto"), F.max("teljesites").alias("utolso"), F.max("fizetesi_hatarido").alias("hatarido"), F.max("vevo_adoszam").alias("adoszam"),
                                                                     F.max("devizanem").alias("devizanem"), F.max("deviza_arfolyam").alias("arfolyam"), F.sum("brutto_huf").alias("brutto_huf"),
                                                                     F.max("eredeti_szamlaszam").alias("eredeti"), F.max("fizetesi_mod").alias("fizetesi_mod")))
query("flatten_invoice_to_gl", f"""select invoice_type, account_code, count(*) n, {dec('sum(case when (invoice_type = $$STORNO$$) = (side = $$C$$) then v else 0 end)')} debit, {dec('sum(case when (invoice_type = $$STORNO$$) = (side = $$D$$) then v else 0 end)')} credit from (
 select invoice_type, '311' account_code, 'D' side, gross v from inv union all select invoice_type, '971', 'C', net from inv union all select invoice_type, '467', 'C', vat from inv) group by all""")(
    lambda b: S.invoices_to_gl(invoice_heads(b)).groupBy("invoice_type", "account_code").agg(n(), F.sum("debit").alias("debit"), F.sum("credit").alias("credit")))


def layouts(b):
    """The same sales in the three ERP layouts, each source with its own column names and text formats; every column has values that differ."""
    k, c = F.col("partkey"), F.col
    s = sales(b).withColumns({
        "account": F.lit("311"), "account_name": F.lit("Receivables"), "document_date": F.date_sub("posting_date", 1), "document_type": F.concat(F.lit("T"), (k % 4).cast("string")),
        "currency": F.when(k % 3 == 0, "EUR").otherwise("HUF"), "fcy": F.when(k % 3 == 0, amount(c("debit") * 2)), "rate": F.when(k % 3 == 0, F.concat((k % 100 + 350).cast("string"), F.lit(".25"))),
        "cost_centre": F.when(k % 7 != 0, F.concat(F.lit("CC"), (k % 50).cast("string"))), "project": F.when(c("suppkey") % 5 != 0, F.concat(F.lit("P"), (c("suppkey") % 20).cast("string"))),
        "text": F.concat(F.lit('said; "'), c("source_id"), F.lit('"')), "year": F.year("posting_date").cast("string"), "month": F.month("posting_date").cast("string"), "version": F.lit("1.2")})
    part = lambda i, **names: s.where(c("suppkey") % 3 == i).select(*[(c(v) if isinstance(v, str) else v).alias(n) for n, v in names.items()])
    text = lambda name: c(name).cast("string")
    return {
        "COBALT": part(0, id="source_id", company_code="company", account_number="account", account_name="account_name", journal_date=text("document_date"), posting_date=text("posting_date"),
                       voucher_number="document_number", voucher_type="document_type", debit_huf=text("debit"), credit_huf=text("credit"), currency="currency", debit_fcy=text("fcy"),
                       credit_fcy=F.lit("0.00"), exchange_rate="rate", cost_center="cost_centre", project_id="project", narration="text", is_reversed=(k % 11 == 0).cast("string"),
                       reversal_of_id=F.when(k % 11 == 0, F.concat(F.lit("R-"), c("source_id"))), fiscal_year="year", fiscal_period="month", cobalt_version="version"),
        "SAP_B1": part(1, TransId="source_id", CompanyDB="company", AccountCode="account", AccountName="account_name", ReferenceDate=F.date_format("posting_date", "yyyyMMdd"),
                       JdtNum=c("document_number").cast("long"), TransactionCode="document_type", Debit=text("debit"), Credit=text("credit"), FCCurrency="currency", FCDebit=text("fcy"),
                       FCCredit=F.lit("0.00"), CostingCode="cost_centre", ProjectCode="project", LineMemo="text"),
        "SZAMLAZZ": part(2, transaction_id="source_id", company_id="company", local_account_code="account", account_description="account_name",
                         transaction_date=F.date_format("document_date", "yyyy.MM.dd"), posting_date=F.date_format("posting_date", "yyyy.MM.dd"), document_number="document_number",
                         document_type="document_type", debit_amount=comma("debit"), credit_amount=comma("credit"), currency_code="currency", debit_amount_fcy=comma("fcy"),
                         credit_amount_fcy=F.lit("0,00"), fx_rate=F.translate("rate", ".", ","), cost_centre_code="cost_centre", project_code="project", description="text", period_year="year",
                         period_month="month", source_system_version="version"),
    }


query("conform_sources", f"""with s as (select *, case suppkey % 3 when 0 then 'COBALT' when 1 then 'SAP_B1' else 'SZAMLAZZ' end source_system, suppkey % 3 src from sale_rows)
 select source_system, company, '311' account_code, posting_date, 'Receivables' account_name, count(*) n, {dec('sum(debit)')} debit, max(source_id) last_id, max(document_number) last_doc,
 max(case when src = 1 then posting_date else posting_date - 1 end) document_date, max('T' || (partkey % 4)) document_type, max(case when partkey % 3 = 0 then 'EUR' else 'HUF' end) currency_code, {dec('sum(case when partkey % 3 = 0 then 2 * debit end)')} debit_fcy,
 max(case when src <> 1 and partkey % 3 = 0 then cast(partkey % 100 + 350 as decimal(38,6)) + 0.25 end) fx_rate, max(case when partkey % 7 <> 0 then 'CC' || (partkey % 50) end) cost_centre, max(case when suppkey % 5 <> 0 then 'P' || (suppkey % 20) end) project,
 min('said; "' || source_id || '"') description, count(case when src = 0 and partkey % 11 = 0 then 1 end) reversals, max(case when src = 0 and partkey % 11 = 0 then 'R-' || source_id end) reversal_of_id,
 max(case when src <> 1 then cast(year(posting_date) as integer) end) fiscal_year, max(case when src <> 1 then cast(month(posting_date) as integer) end) fiscal_period, max(case when src <> 1 then '1.2' end) source_version from s group by all""")(
    lambda b: S.require_known_source(S.conform_all(layouts(b)), K.SOURCE_SYSTEMS).groupBy("source_system", "company", "account_code", "posting_date", "account_name").agg(
        n(), F.sum("debit").alias("debit"), F.max("source_id").alias("last_id"), F.max("document_number").alias("last_doc"), *[F.max(c).alias(c) for c in (
            "document_date", "document_type", "currency_code", "fx_rate", "cost_centre", "project", "reversal_of_id", "fiscal_year", "fiscal_period", "source_version")],
        F.sum("debit_fcy").alias("debit_fcy"), F.min("description").alias("description"), F.count(F.when(F.col("is_reversal"), 1)).alias("reversals")))


def export_daily(b):
    """A month's file of daily sales per company, in order, so that its bytes are known. The calendar and the companies bound a file."""
    path = fresh_path(b.spark, "daily-extract")
    days = sales(b).groupBy("posting_date", "company").agg(F.count("*").alias("n"), F.sum("debit").alias("debit"))
    lines = days.select(F.year("posting_date").alias("year"), F.month("posting_date").alias("month"), "posting_date", "company",
                        F.concat_ws(";", F.date_format("posting_date", "yyyy-MM-dd"), "company", F.col("n").cast("string"), F.col("debit").cast("string")).alias("value"))
    placed = lines.repartition("year", "month").sortWithinPartitions("year", "month", "posting_date", "company")
    placed.select("year", "month", "value").write.partitionBy("year", "month").text(path)
    return path


TABLES["daily_files"] = """select cast(year(posting_date) as varchar) || cast(month(posting_date) as varchar) period_detected, string_agg(line || chr(10), '' order by posting_date, company) content from (
 select posting_date, company, strftime(posting_date, '%Y-%m-%d') || ';' || company || ';' || cast(count(*) as varchar) || ';' || cast(sum(debit) as varchar) line from sale_rows group by posting_date, company) group by 1"""
query("ingestion_manifest", "select period_detected, cast(octet_length(encode(content)) as bigint) file_bytes, sha256(content) content_hash, 'TXT' file_format, 'RECEIVED' status from daily_files")(
    lambda b: M.manifest(M.scan_files(b.spark, export_daily(b))).drop("path", "file_name"))
query("landing_check", """select count(*) files, cast(sum(s) as bigint) bytes, min(s) smallest, count(case when s < 1024 then 1 end) too_small, case when min(s) < 1024 then 'TOO_SMALL' else 'OK' end status from (
 select cast(octet_length(encode(content)) as bigint) s from daily_files)""")(lambda b: M.landing_check(M.scan_files(b.spark, export_daily(b))))
query("manifest_duplicates", """with f as (select doc_id file_id, sha256(text) content_hash, doc_id * 7 % 1000 received_at from documents)
 select file_id, content_hash, received_at, case when file_id = first_id then 'NEW' else 'DUPLICATE' end status, case when file_id <> first_id then first_id end duplicate_of
 from (select *, first_value(file_id) over (partition by content_hash order by received_at, file_id) first_id from f)""")(
    lambda b: M.mark_duplicates(b.t("documents").select(F.col("doc_id").alias("file_id"), F.sha2("text", 256).alias("content_hash"), (F.col("doc_id") * 7 % 1000).alias("received_at"))))
query("retention_tiers", """select case when age < 90 then 'HOT' when age < 730 then 'COOL' when age < 2922 then 'ARCHIVE' when age < 3650 then 'RELEASED' else 'DELETE' end tier, count(*) n, min(d) oldest, max(d) newest
 from (select cast(l_shipdate as date) d, date_diff('day', cast(l_shipdate as date), date '2001-12-31') age from lineitem) group by all""")(
    lambda b: b.t("lineitem").select(F.to_date("l_shipdate").alias("d")).groupBy(M.retention_tier("d", "2001-12-31").alias("tier")).agg(n(), F.min("d").alias("oldest"), F.max("d").alias("newest")))
query("fx_rate_ingest", """with span as (select currency_code, unnest(generate_series(min(rate_date), max(rate_date), interval 1 day)) ts from rates group by 1)
 select s.currency_code, cast(ts as date) "day", last_value(rate_to_huf ignore nulls) over (partition by s.currency_code order by ts rows unbounded preceding) rate_to_huf, rate_to_huf is null is_carried
 from span s left join rates r on r.currency_code = s.currency_code and r.rate_date = cast(ts as date)""")(lambda b: fx_ops.daily_fixing(b.fx_rates))


def seed_load(b):
    """A typed account seed written as text, every sixth row one field short; short rows are kept aside as corrupt."""
    path = fresh_path(b.spark, "seed")
    posted = b.trial_balance.select("entity_key", "account_code").distinct().join(b.accounts, "account_code")
    row = F.concat_ws(",", "entity_key", "account_code", "universal_node", "account_type", "normal_balance")
    short = F.concat_ws(",", "entity_key", "account_code", "universal_node", "account_type")
    posted.select(F.when((F.col("entity_key") + F.length("universal_node")) % 6 == 0, short).otherwise(row).alias("value")).write.text(path)
    return b.spark.read.schema("company INT, account_code STRING, universal_node STRING, account_type STRING, normal_balance STRING, corrupt STRING").options(
        mode="PERMISSIVE", columnNameOfCorruptRecord="corrupt", columnPruning=False).csv(path)


query("seed_load", """select entity_key company, count(*) n, count(case when (entity_key + length(universal_node)) % 6 = 0 then 1 end) corrupt,
 count(case when (entity_key + length(universal_node)) % 6 <> 0 and normal_balance = 'C' then 1 end) credit_normal from (select distinct entity_key, account_code from tb) t join coa c on t.account_code = c.account_code group by all""")(
    lambda b: seed_load(b).groupBy("company").agg(n(), F.count("corrupt").alias("corrupt"), F.count(F.when(F.col("corrupt").isNull() & (F.col("normal_balance") == "C"), 1)).alias("credit_normal")))

# ---- sinks ----------------------------------------------------------------------------------------------------
TXN = ["transaction_id", "batch_id", "entity_key", "period_key", "account_code", "net"]
postings = lambda b, on_lines=None: b.ledger(on_lines=on_lines).select(*TXN)
by_month = lambda lines: lines.hint("rebalance", "period_key")  # an order line's postings are all of its month
POSTINGS = "(select transaction_id, batch_id, entity_key, period_key, account_code, net from gl)"
by_period = lambda df: df.groupBy("period_key").agg(n(), F.sum("net").alias("net"))
BY_PERIOD = f"select period_key, count(*) n, {dec('sum(net)')} net from"


def full_refresh(b):
    path = fresh_path(b.spark, "refresh")
    sinks.full_refresh(b.trial_balance.limit(0), path)
    return sinks.full_refresh(b.trial_balance, path)


query("sink_full_refresh", f"{BY_PERIOD} tb group by all")(lambda b: by_period(full_refresh(b)))
query("sink_incremental_batches", f"select period_key, count(distinct batch_id) batches, count(*) n, {dec('sum(net)')} net from {POSTINGS} where batch_id not in (select batch_id from {POSTINGS} where period_key < 199901 or entity_key % 3 = 0) group by all")(
    lambda b: sinks.new_batches(postings(b), postings(b).where("period_key < 199901 OR entity_key % 3 = 0")).groupBy("period_key").agg(
        F.countDistinct("batch_id").alias("batches"), n(), F.sum("net").alias("net")))


def merge_by_key(b):
    """A load with several versions of a key, some in another month, and keys that move away from a month the load doesn't name."""
    path = fresh_path(b.spark, "fact")
    p = postings(b)
    sinks.write_unfolded(postings(b, by_month).where("period_key < 200007"), path, "period_key", ["entity_key", "account_code"])
    version = lambda where, more, month=None: p.where(where).withColumns(
        {"net": amount(F.col("net") + more)} | ({"period_key": F.lit(month)} if month else {}))
    updates = [version("period_key >= 200001", 1), version("period_key = 200003", 2), version("period_key = 200005 AND entity_key % 3 = 0", 5, 200006),
               version("period_key = 199912 AND entity_key % 2 = 0", 3, 200002)]
    return sinks.merge_partitions(path, reduce(lambda x, y: x.unionByName(y), updates), ["transaction_id"], "period_key", ["entity_key", "account_code"], ["net"])


query("sink_merge_by_key", f"""with p as {POSTINGS}, v as (select * replace (net + 1 as net) from p where period_key >= 200001 union all select * replace (net + 2 as net) from p where period_key = 200003
 union all select * replace (200006 as period_key, net + 5 as net) from p where period_key = 200005 and entity_key % 3 = 0 union all select * replace (200002 as period_key, net + 3 as net) from p where period_key = 199912 and entity_key % 2 = 0),
 r as (select * from v union all select * from p where period_key < 200007 and transaction_id in (select transaction_id from v)),
 u as (select *, row_number() over (partition by transaction_id order by net desc, batch_id desc, entity_key desc, period_key desc) place from r)
 {BY_PERIOD} (select cast(period_key as integer) period_key, net from p where period_key < 200007 and transaction_id not in (select transaction_id from v) union all select cast(period_key as integer), net from u where place = 1) group by all""")(
    lambda b: by_period(merge_by_key(b)))


def insert_ignore(b):
    """A load with two versions of every key: known keys are ignored, new ones come in once, with the later version."""
    p = postings(b)
    # both versions of a row come out of one scan, next to each other
    load = p.where("period_key >= 199907").withColumn("net", F.explode(F.array(*[amount(F.col("net") + more) for more in (5, 4)])))
    return sinks.inserted(p.where("period_key < 200007"), load, ["transaction_id"], ["net"])


query("sink_insert_ignore", f"""with p as {POSTINGS} {BY_PERIOD} (select period_key, net from p where period_key < 200007 union all
 select period_key, net + 5 from p where period_key >= 199907 and transaction_id not in (select transaction_id from p where period_key < 200007)) group by all""")(
    lambda b: by_period(insert_ignore(b)))
SLICE = ["entity_key", "period_key", "account_code"]
query("sink_replace_slice", f"""select entity_key, period_key, account_code, {dec('sum(net)')} net from (select entity_key, period_key, account_code, case when period_key >= 200001 and entity_key % 2 = 0 then 2 * net else net end net from tb) group by all""")(
    lambda b: (lambda t: sinks.merged(t, t.where("period_key >= 200001 AND entity_key % 2 = 0").withColumn("net", F.col("net") * 2), SLICE))(
        b.trial_balance.groupBy(*SLICE).agg(F.sum("net").cast("decimal(38,2)").alias("net"))))


def partitioned(b):
    path = fresh_path(b.spark, "fact-by-month")
    sinks.write_partitioned(b.ledger().select("entity_code", "account_code", "net", "period_key"), path, "period_key", ["entity_code", "account_code"])
    return b.spark.read.parquet(path)


query("sink_partitioned_by_month", f"select cast(period_key as integer) period_key, entity_code, count(*) n, {dec('sum(net)')} net from gl group by all")(
    lambda b: partitioned(b).groupBy("period_key", "entity_code").agg(n(), F.sum("net").alias("net")))
query("dedupe_first", "select * from (select source_id, company, posting_date, partkey, debit, row_number() over (partition by source_id order by posting_date, partkey, debit) rn from sale_rows) where rn = 1".replace("select * from", "select source_id, company, posting_date, partkey, debit from"))(
    lambda b: W.first_per_key(sales(b).select("source_id", "company", "posting_date", "partkey", "debit"), ["source_id"], ["posting_date", "partkey", "debit"])
    .select("source_id", "company", "posting_date", "partkey", "debit"))
