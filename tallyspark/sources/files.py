"""Readers for landed files. Schemas are declared, never inferred; amounts arrive as text and are typed in staging."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import parse_comma_decimal


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_delimited(spark: SparkSession, path: str, columns: list[str], **options) -> DataFrame:
    """Semicolon text with header, double quotes, backslash escapes; an empty field is null."""
    return (spark.read.schema(text_schema(columns)).options(sep=";", header=True, quote='"', escape="\\", nullValue="", encoding="UTF-8",
                                                           recursiveFileLookup=True, **options).csv(path))


def write_delimited(df: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    df.write.mode("append").options(sep=";", header=True, quote='"', escape="\\", nullValue="", maxRecordsPerFile=max_rows).csv(path)


def with_path_columns(df: DataFrame) -> DataFrame:
    """Company, year and month taken from the folder names of each file."""
    path = F.col("_metadata.file_path")
    part = lambda name: F.url_decode(F.regexp_extract(path, rf"/{name}=([^/]+)/", 1))
    return df.select("*", part("entity").alias("entity"), part("year").cast("int").alias("year"), part("month").cast("int").alias("month"))


def read_since(spark: SparkSession, path: str, columns: list[str], since: str) -> DataFrame:
    """Only files modified after the given time; older files are not opened."""
    return read_delimited(spark, path, columns, modifiedAfter=since)


JOURNAL_SCHEMA = ("value ARRAY<STRUCT<JdtNum: BIGINT, TransId: STRING, ReferenceDate: STRING, DueDate: STRING, Memo: STRING, "
                  "TransactionCode: STRING, lines: ARRAY<STRUCT<LineNum: INT, AccountCode: STRING, AccountName: STRING, Debit: STRING, Credit: STRING, "
                  "DebitSys: STRING, CreditSys: STRING, FCCurrency: STRING, FCDebit: STRING, FCCredit: STRING, CostingCode: STRING, ProjectCode: STRING, "
                  "LineMemo: STRING>>>>")
MONEY = "decimal(18,2)"


def read_journals(spark: SparkSession, path: str) -> DataFrame:
    """Pages of journals with nested lines, flattened to one row per line. one page per text line keeps plain files splittable."""
    pages = spark.read.schema(JOURNAL_SCHEMA).json(path)
    journals = pages.select(F.explode("value").alias("j")).select("j.*")
    line = lambda name, alias: F.col(f"l.{name}").alias(alias)
    money = lambda name, alias: F.col(f"l.{name}").try_cast(MONEY).alias(alias)
    return journals.select("JdtNum", "TransId", "ReferenceDate", "DueDate", "Memo", "TransactionCode", F.explode("lines").alias("l")).select(
        "JdtNum", "TransId", F.to_date("ReferenceDate").alias("reference_date"), F.to_date("DueDate").alias("due_date"), F.col("Memo").alias("memo"), "TransactionCode",
        line("LineNum", "line_num"), line("AccountCode", "account_code"), line("AccountName", "account_name"), money("Debit", "debit"), money("Credit", "credit"),
        money("DebitSys", "debit_system"), money("CreditSys", "credit_system"), line("FCCurrency", "currency_code"), money("FCDebit", "debit_fcy"), money("FCCredit", "credit_fcy"),
        line("CostingCode", "cost_centre"), line("ProjectCode", "project"), line("LineMemo", "line_memo"))


INVOICE_SCHEMA = ("szamlaszam STRING, kelte DATE, teljesites DATE, fizetesi_hatarido DATE, vevo_nev STRING, vevo_adoszam STRING, vevo_orszag STRING, netto_osszeg DECIMAL(18,2), "
                  "afa_osszeg DECIMAL(18,2), brutto_osszeg DECIMAL(18,2), devizanem STRING, deviza_arfolyam DECIMAL(16,6), netto_huf DECIMAL(18,2), brutto_huf DECIMAL(18,2), "
                  "fizetesi_mod STRING, szamla_tipus STRING, eredeti_szamlaszam STRING, megjegyzes STRING, exported_at TIMESTAMP")


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").schema(INVOICE_SCHEMA).option("rowTag", "szamla").load(path)


LEDGER_SCHEMA = {
    "source_id": "string", "company": "string", "account_code": "string", "account_name": "string", "document_date": "date", "posting_date": "date", "document_number": "string",
    "document_type": "string", "debit": MONEY, "credit": MONEY, "currency_code": "string", "debit_fcy": MONEY, "credit_fcy": MONEY, "fx_rate": "decimal(16,6)", "cost_centre": "string",
    "project": "string", "description": "string", "is_reversal": "boolean", "reversal_of_id": "string", "fiscal_year": "int", "fiscal_period": "int", "source_version": "string"}
LEDGER_COLUMNS = ["source_system", *LEDGER_SCHEMA]
#: Column of each layout for each ledger column; what a layout does not have is null.
LAYOUTS = {
    "COBALT": {"source_id": "id", "company": "company_code", "account_code": "account_number", "account_name": "account_name", "document_date": "journal_date", "posting_date": "posting_date",
               "document_number": "voucher_number", "document_type": "voucher_type", "debit": "debit_huf", "credit": "credit_huf", "currency_code": "currency", "debit_fcy": "debit_fcy",
               "credit_fcy": "credit_fcy", "fx_rate": "exchange_rate", "cost_centre": "cost_center", "project": "project_id", "description": "narration", "is_reversal": "is_reversed",
               "reversal_of_id": "reversal_of_id", "fiscal_year": "fiscal_year", "fiscal_period": "fiscal_period", "source_version": "cobalt_version"},
    "SAP_B1": {"source_id": "TransId", "company": "CompanyDB", "account_code": "AccountCode", "account_name": "AccountName", "document_date": "ReferenceDate", "posting_date": "ReferenceDate",
               "document_number": "JdtNum", "document_type": "TransactionCode", "debit": "Debit", "credit": "Credit", "currency_code": "FCCurrency", "debit_fcy": "FCDebit",
               "credit_fcy": "FCCredit", "cost_centre": "CostingCode", "project": "ProjectCode", "description": "LineMemo"},
    "SZAMLAZZ": {"source_id": "transaction_id", "company": "company_id", "account_code": "local_account_code", "account_name": "account_description", "document_date": "transaction_date",
                 "posting_date": "posting_date", "document_number": "document_number", "document_type": "document_type", "debit": "debit_amount", "credit": "credit_amount",
                 "currency_code": "currency_code", "debit_fcy": "debit_amount_fcy", "credit_fcy": "credit_amount_fcy", "fx_rate": "fx_rate", "cost_centre": "cost_centre_code",
                 "project": "project_code", "description": "description", "fiscal_year": "period_year", "fiscal_period": "period_month", "source_version": "source_system_version"},
}
DATE_FORMATS = {"COBALT": "yyyy-MM-dd", "SAP_B1": "yyyyMMdd", "SZAMLAZZ": "yyyy.MM.dd"}


def conform(df: DataFrame, source_system: str) -> DataFrame:
    """One ERP layout to the common ledger columns, each with its own date and number format; an unknown source stops the job."""
    if source_system not in LAYOUTS:
        raise ValueError(f"unknown source system {source_system}")
    names = LAYOUTS[source_system]

    def typed(column: str, kind: str):
        if names.get(column) not in df.columns:
            return F.lit(None).cast(kind)
        c = F.col(names[column])
        if kind == "date":
            return F.to_date(c.cast("string"), DATE_FORMATS[source_system])
        if kind.startswith("decimal") and source_system == "SZAMLAZZ":
            return (parse_comma_decimal(names[column]) if kind == MONEY else F.translate(c, ",", ".")).try_cast(kind)
        return c.try_cast(kind)

    return df.select(F.lit(source_system).alias("source_system"), *[typed(c, kind).alias(c) for c, kind in LEDGER_SCHEMA.items()])


def conform_all(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [conform(df, name) for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def require_known_source(df: DataFrame, known: list[str]) -> DataFrame:
    """Fail on the first row whose source system has no layout."""
    checked = F.when(F.col("source_system").isin(*known), F.col("source_system")).otherwise(
        F.raise_error(F.concat(F.lit("no layout for source system "), F.coalesce("source_system", F.lit("null")))))
    return df.withColumn("source_system", checked)


def invoices_to_gl(invoices: DataFrame) -> DataFrame:
    """Invoice heads to balanced legs: gross to receivables, net to income, tax to payables; a cancellation swaps the sides."""
    c = F.col
    zero = F.lit(0).cast("decimal(18,2)")
    cancel = c("invoice_type") == "STORNO"
    leg = lambda no, account, value, side: F.struct(
        F.lit(no).alias("leg_no"), F.lit(account).alias("account_code"),
        F.when(cancel == F.lit(side == "C"), c(value)).otherwise(zero).alias("debit"),
        F.when(cancel == F.lit(side == "D"), c(value)).otherwise(zero).alias("credit"))
    legs = F.array(leg(1, "311", "gross", "D"), leg(2, "971", "net", "C"), leg(3, "467", "vat", "C"))
    return invoices.withColumn("x", F.explode(legs)).select(*[f for f in invoices.columns], "x.*")
