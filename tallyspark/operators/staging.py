"""Typing and flagging of raw (all-text) uploads."""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.money import amount
from ..functions.periods import period_key_of
from ..functions.text import fingerprint
from ..plans import constants as K


LINE_TEXTS = ["posting_date", "document_date", "ingestion_date", "is_intercompany"]


def line_texts(lines: DataFrame) -> DataFrame:
    """Text of what all postings of an order line share, so that it is written once a line."""
    return lines.withColumns({
        **{f"{c}_text": F.col(c).cast("string") for c in LINE_TEXTS},
        "period_year_text": F.floor(F.col("period_key") / 100).cast("string"), "period_month_text": (F.col("period_key") % 100).cast("string")})


def bronze_ledger(ledger: DataFrame) -> DataFrame:
    """The ledger as it lands: text only, with some rows lacking a company or an account. Texts that its lines bring are taken as they are."""
    ready = set(ledger.columns)
    text_of = lambda c, made: (F.col(f"{c}_text") if f"{c}_text" in ready else made.cast("string")).alias(c)
    text = lambda c: text_of(c, F.col(c))
    return ledger.select(
        *[text(c) for c in ["transaction_id", "batch_id", "source_system", "posting_date", "document_date", "debit", "credit",
                            "currency_code", "debit_fcy", "credit_fcy", "document_number", "is_intercompany", "ingestion_date"]],
        F.when(F.col("partkey") % 101 != 0, F.col("entity_code")).alias("entity_code"),
        F.when(F.col("partkey") % 103 != 0, F.col("account_code")).alias("account_code"),
        text_of("period_year", F.floor(F.col("period_key") / 100)),
        text_of("period_month", F.col("period_key") % 100),
    )


def is_late_relative(posting_date, period_year, as_of: str, days: int = K.LATE_AFTER_DAYS) -> Column:
    """Posted more than `days` before the closing date and belonging to an earlier year."""
    closing = F.to_date(F.lit(as_of))
    return (F.col(posting_date) < F.date_sub(closing, days)) & (F.col(period_year) < F.year(closing))


def flag_unmapped(df: DataFrame, accounts: DataFrame, out: str = "is_unmapped_account") -> DataFrame:
    known = accounts.select(F.col("account_code").alias("_known")).distinct()
    return df.join(known, F.col("account_code") == F.col("_known"), "left").withColumn(out, F.col("_known").isNull()).drop("_known")


def stage_gl(raw: DataFrame, accounts: DataFrame, as_of: str = K.AS_OF) -> DataFrame:
    """Typed posting lines; rows without company or account are refused."""
    typed = raw.where("entity_code IS NOT NULL AND account_code IS NOT NULL").select(
        "transaction_id", "batch_id", "entity_code", "source_system", "account_code", "document_number", "currency_code",
        *[F.col(c).cast("date").alias(c) for c in ("posting_date", "document_date", "ingestion_date")],
        *[F.col(c).cast("int").alias(c) for c in ("period_year", "period_month")],
        *[amount(c).alias(c) for c in ("debit", "credit", "debit_fcy", "credit_fcy")],
        F.col("is_intercompany").cast("boolean").alias("is_intercompany"),
    )
    return flag_unmapped(typed, accounts).withColumns({
        "net": amount(F.col("debit") - F.col("credit")),
        "period_key": period_key_of("period_year", "period_month"),
        "is_late_entry": is_late_relative("posting_date", "period_year", as_of),
        "row_hash": row_fingerprint(),
    })


FINGERPRINT = ["entity_code", "account_code", "posting_date", "document_number", "debit", "credit"]


def row_fingerprint() -> Column:
    return fingerprint(*FINGERPRINT)


def flag_late_closed_period(df: DataFrame, calendar: DataFrame) -> DataFrame:
    """Document date inside a closed period of the entity's calendar (entity_key, period_key, is_closed)."""
    cal = calendar.select(F.col("entity_key").alias("_e"), F.col("period_key").alias("_p"), "is_closed")
    doc_period = period_key_of(F.year("document_date"), F.month("document_date"))
    return (
        df.join(cal, (F.col("entity_key") == F.col("_e")) & (doc_period == F.col("_p")), "left")
        .withColumn("is_late_closed", F.coalesce("is_closed", F.lit(False))).drop("_e", "_p", "is_closed")
    )


def ingestion_lag_days() -> Column:
    return F.date_diff("ingestion_date", F.last_day("posting_date"))


def stage_balance_sheet(raw: DataFrame) -> DataFrame:
    """Account class is the first digit; class 4 is credit-normal."""
    account_class = F.substring("account_code", 1, 1).cast("int")
    return raw.where("entity_key IS NOT NULL AND period_year IS NOT NULL AND account_code IS NOT NULL").withColumns({
        "period_key": period_key_of("period_year", "period_month"),
        "account_class": account_class,
        "normal_balance": F.when(account_class == 4, "C").otherwise("D"),
    })


def signed_balance(balance, normal_balance) -> Column:
    return F.when(F.col(normal_balance) == "C", -F.col(balance)).otherwise(F.col(balance))


def stage_budget(raw: DataFrame) -> DataFrame:
    """Version names are folded into three; an unknown name counts as the original budget."""
    folded = F.coalesce(F.create_map(*[F.lit(x) for kv in K.BUDGET_ALIASES.items() for x in kv])[F.upper("budget_version")],
                        F.lit("ORIGINAL_BUDGET"))
    return raw.where("entity_key IS NOT NULL AND account_code IS NOT NULL AND budget_amount IS NOT NULL").withColumns({
        "period_key": period_key_of("period_year", "period_month"), "budget_version": folded,
    })
