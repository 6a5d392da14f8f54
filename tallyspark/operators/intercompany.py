"""Intercompany flags. The registry names two sides per pair; unpivoted to (entity, account) rows it joins on equality, where the
two-sided OR condition would force a nested loop. One row per key keeps the posting count unchanged."""

from pyspark.sql import DataFrame, functions as F


def registry_sides(registry: DataFrame) -> DataFrame:
    sides = registry.where("is_active").select("pair_id", "transaction_type", "elimination_type", F.explode(F.array(
        F.struct(F.col("seller_key").alias("entity_key"), F.col("seller_account").alias("account_code"), F.lit("SELLER").alias("ic_side")),
        F.struct(F.col("buyer_key").alias("entity_key"), F.col("buyer_account").alias("account_code"), F.lit("BUYER").alias("ic_side")))).alias("s"))
    return sides.select("s.*", "pair_id", "transaction_type", "elimination_type").groupBy("entity_key", "account_code").agg(
        F.min_by(F.struct("ic_side", "transaction_type", "elimination_type"), "pair_id").alias("m")).select("entity_key", "account_code", "m.*")


def flag_transactions(postings: DataFrame, registry: DataFrame) -> DataFrame:
    sides = registry_sides(registry).withColumnRenamed("entity_key", "_e").withColumnRenamed("account_code", "_a")
    return (
        postings.join(sides, (F.col("entity_key") == F.col("_e")) & (F.col("account_code") == F.col("_a")), "left")
        .withColumn("is_ic_transaction", F.col("_e").isNotNull())
        .withColumn("ic_transaction_type", F.coalesce("transaction_type", F.lit("NON_IC"))).drop("_e", "_a", "transaction_type")
    )


def flag_effective_dated(postings: DataFrame, registry: DataFrame) -> DataFrame:
    """Relation from the registry rows valid on the posting date, by company, account and counterparty.

    Relations of one such key are kept in a list, of which the first valid one counts: a posting stays one row.
    """
    relation = F.struct("pair_id", "elimination_type", "valid_from", "valid_to")
    active = registry.where("is_active").select(relation.alias("_r"), F.explode(F.array(
        F.struct(F.col("seller_key").alias("_e"), F.col("seller_account").alias("_a"), F.col("buyer_key").alias("_c")),
        F.struct(F.col("buyer_key").alias("_e"), F.col("buyer_account").alias("_a"), F.col("seller_key").alias("_c")))).alias("s"))
    known = active.groupBy("s._e", "s._a", "s._c").agg(F.sort_array(F.collect_list("_r")).alias("_known"))
    day = F.col("posting_date")
    valid = F.filter("_known", lambda r: (day >= r["valid_from"]) & (r["valid_to"].isNull() | (day <= r["valid_to"])))
    matched = postings.join(known, (F.col("entity_key") == F.col("_e")) & (F.col("account_code") == F.col("_a")) & (F.col("counterparty_key") == F.col("_c")), "left")
    return matched.withColumn("_r", F.get(valid, F.lit(0))).withColumns(
        {"pair_id": F.col("_r.pair_id"), "elimination_type": F.col("_r.elimination_type"), "is_ic_effective": F.col("_r").isNotNull()}).drop("_e", "_a", "_c", "_known", "_r")


def flag_mismatches(postings: DataFrame, accounts: DataFrame, registry: DataFrame) -> DataFrame:
    """Account is an intercompany account, yet no active registry row covers the posting."""
    ic_accounts = accounts.where("is_ic_account").select("account_code")
    return flag_transactions(postings.join(ic_accounts, "account_code", "left_semi"), registry).where(~F.col("is_ic_transaction"))
