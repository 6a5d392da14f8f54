"""Versioned mappings, restatements, queues and publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.money import ratio, sum_where

TRACKED = ["account_name", "universal_node", "account_type", "normal_balance", "l1_category", "l2_subcategory", "pl_line_item",
           "cf_classification", "is_ic_account"]


def tracked_hash(columns: list[str]):
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def scd2_first(version: DataFrame, tracked: list[str], valid_from: str) -> DataFrame:
    return version.withColumns({"row_digest": tracked_hash(tracked), "valid_from": F.to_date(F.lit(valid_from)),
                                "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)})


def scd2_apply(snapshot: DataFrame, version: DataFrame, keys: list[str], tracked: list[str], as_of: str) -> DataFrame:
    """Next state of a type-2 table: changed and vanished rows are closed, changed and new rows opened, the rest kept.

    One full outer join of the current rows with the new version on the key decides all three cases.
    """
    day = F.to_date(F.lit(as_of))
    new = version.withColumn("row_digest", tracked_hash(tracked))
    old = snapshot.where("is_current")
    n = new.select(*[F.col(c).alias(f"n_{c}") for c in new.columns])
    both = old.join(n, [F.col(k) == F.col(f"n_{k}") for k in keys], "full")
    had, has = F.col(keys[0]).isNotNull(), F.col(f"n_{keys[0]}").isNotNull()
    same = F.coalesce(F.col("row_digest") == F.col("n_row_digest"), F.lit(False))
    columns = version.columns
    kept = F.struct(*[F.col(c) for c in columns], F.col("row_digest"), F.col("valid_from"),
                    F.when(same, F.col("valid_to")).otherwise(day).alias("valid_to"), same.alias("is_current"))
    opened = F.struct(*[F.col(f"n_{c}").alias(c) for c in columns], F.col("n_row_digest").alias("row_digest"), day.alias("valid_from"),
                      F.lit(None).cast("date").alias("valid_to"), F.lit(True).alias("is_current"))
    rows = F.filter(F.array(F.when(had, kept), F.when(has & ~same, opened)), lambda x: x.isNotNull())
    return snapshot.where("NOT is_current").unionByName(both.select(F.explode(rows).alias("r")).select("r.*"))


def valid_at(facts: DataFrame, mapping: DataFrame, keys: list[str], day: str, columns: list[str]) -> DataFrame:
    """Mapping version valid on the day (closed-open intervals that don't overlap within a key), by a merge instead of a range join.

    Facts and versions of a key and month are put in the order of their days, and every fact takes the last version before it. The version that
    is still valid when a month begins is carried into it, found among one row per key and month. So the work is linear, however many
    versions a key has, and a large key is split by month.
    """
    version = F.struct("valid_from", "valid_to", *columns)
    month = lambda d: F.trunc(d, "MM")
    named = mapping.where(F.col("valid_from").isNotNull()).select(*keys, month("valid_from").alias("_month"), F.col("valid_from").alias("_day"), version.alias("_version"))
    asked = facts.where(F.col(day).isNotNull()).select(*keys, month(day).alias("_month")).distinct()
    last = named.groupBy(*keys, "_month").agg(F.max(F.struct("_day", "_version"))["_version"].alias("_version"))
    months = asked.withColumn("_asked", F.lit(1)).join(last, [*keys, "_month"], "full")
    before = Window.partitionBy(*keys).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)
    carried = months.withColumn("_carried", F.last("_version", ignorenulls=True).over(before)).where("_asked = 1 AND _carried IS NOT NULL").select(
        *keys, "_month", F.col("_month").alias("_day"), F.lit(0).alias("_turn"), F.col("_carried").alias("_version"))
    starts = named.join(asked, [*keys, "_month"], "left_semi").select(*keys, "_month", "_day", F.lit(1).alias("_turn"), "_version")
    rest = [c for c in facts.columns if c not in keys]
    rows = facts.where(F.col(day).isNotNull()).select(*keys, month(day).alias("_month"), F.col(day).alias("_day"), F.lit(2).alias("_turn"), F.struct(*rest).alias("_fact"))
    timeline = carried.unionByName(starts).unionByName(rows, allowMissingColumns=True)
    upto = Window.partitionBy(*keys, "_month").orderBy("_day", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    merged = timeline.withColumn("_valid", F.last("_version", ignorenulls=True).over(upto)).where("_turn = 2")
    valid = F.col("_valid").isNotNull() & (F.col("_valid.valid_to").isNull() | (F.col("_day") < F.col("_valid.valid_to")))
    found = merged.where(valid).select(*keys, "_fact.*", *[F.col(f"_valid.{c}").alias(c) for c in columns])
    return found.select(*facts.columns, *columns)


def restatement(postings: DataFrame, keys: list[str], late) -> DataFrame:
    """Balance as first reported against the balance with late entries, where late entries changed something."""
    zero = F.lit(0).cast("decimal(18,2)")
    return postings.groupBy(*keys).agg(
        F.sum(F.when(late, zero).otherwise(F.col("net"))).alias("original_amount"), F.sum("net").alias("restated_amount"),
        F.count(F.when(late, 1)).alias("late_entries")).where("late_entries > 0").withColumns({
            "delta": F.col("restated_amount") - F.col("original_amount"),
            "delta_pct": ratio(F.col("restated_amount") - F.col("original_amount"), F.abs("original_amount"), 4, 100)})


def late_id_chunks(postings: DataFrame, keys: list[str], late, ident: str = "transaction_id", size: int = 1000) -> DataFrame:
    """Ids of the late entries as arrays of about `size`: a large group becomes many rows by a hash of the id, none of them unbounded."""
    rows = postings.where(late).select(*keys, ident)
    counts = rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("long").alias("_chunks"))
    chunk = F.conv(F.substring(F.md5(ident), 1, 8), 16, 10).cast("long") % F.col("_chunks")
    return rows.join(counts, keys).groupBy(*keys, chunk.alias("chunk_no")).agg(F.sort_array(F.collect_list(ident)).alias("late_ids"))


def publish(queue: DataFrame, published: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Approved entries that are not out yet, and the queue with their new state. A second run publishes nothing."""
    done = published.select("source_queue_id")
    new = queue.where("status = 'APPROVED'").join(done, F.col("queue_id") == F.col("source_queue_id"), "left_anti").select(
        F.col("queue_id").alias("source_queue_id"), "entity_key", "period_key", "role", "content")
    out = new.select(F.col("source_queue_id").alias("_id")).unionByName(published.select(F.col("source_queue_id").alias("_id")))
    state = queue.join(out, F.col("queue_id") == F.col("_id"), "left").withColumn(
        "status", F.when(F.col("_id").isNotNull(), "PUBLISHED").otherwise(F.col("status"))).drop("_id")
    return published.unionByName(new.select(*published.columns)), state


def supersede(queue: DataFrame, keys: list[str], order: str = "queue_id") -> DataFrame:
    """Only the latest pending row per key stays pending; the newest id is an aggregate that joins back as one row per key."""
    newest = queue.where("status = 'PENDING'").groupBy(*keys).agg(F.max(order).alias("_newest"))
    return queue.join(newest, keys, "left").withColumn(
        "status", F.when((F.col("status") == "PENDING") & (F.col(order) < F.col("_newest")), "SUPERSEDED").otherwise(F.col("status"))).drop("_newest")


def late_materiality(postings: DataFrame, accounts: DataFrame, late, revenue_share: float = 0.005, opex_share: float = 0.02) -> DataFrame:
    """Late amounts against 0.5 % of revenue and 2 % of operating cost of the month."""
    size = F.abs("net")
    l1 = F.col("l1_category")
    signed = F.when(F.col("account_type") == "Revenue", -F.col("net")).otherwise(F.col("net"))
    frame = postings.join(accounts, "account_code").groupBy("entity_key", "period_key").agg(
        sum_where(l1 == "Revenue", signed).alias("revenue"), sum_where(l1 == "OPEX", signed).alias("opex"),
        F.sum(F.when(late & (l1 == "Revenue"), size)).alias("late_revenue"), F.sum(F.when(late & (l1 == "OPEX"), size)).alias("late_opex"))
    over = lambda part, whole, share: F.coalesce(ratio(F.col(part), F.col(whole), 6) > share, F.lit(False))
    return frame.withColumns({"revenue_share": ratio(F.col("late_revenue"), F.col("revenue"), 6), "opex_share": ratio(F.col("late_opex"), F.col("opex"), 6),
                              "is_material": over("late_revenue", "revenue", revenue_share) | over("late_opex", "opex", opex_share)})


def active_budget(versions: DataFrame) -> DataFrame:
    """The approved version of highest number per entity and year is the active one."""
    return versions.where("approved").groupBy("entity_key", "fiscal_year").agg(F.max_by("budget_version", "version_no").alias("budget_version"))
