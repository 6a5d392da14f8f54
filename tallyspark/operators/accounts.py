"""Account mapping."""

from pyspark.sql import Column, DataFrame, functions as F


def signed_amount(debit="debit", credit="credit", account_type="account_type") -> Column:
    """Income is credit-normal, everything else debit-normal."""
    d, c = F.col(debit), F.col(credit)
    return F.when(F.col(account_type) == "Revenue", c - d).otherwise(d - c)


def map_accounts(postings: DataFrame, accounts: DataFrame, on=("account_code",)) -> DataFrame:
    """Postings with their taxonomy; unmapped postings drop out (see `quarantine_unmapped`)."""
    mapped = postings.join(accounts, list(on))
    return mapped.withColumn("signed", signed_amount().cast(postings.schema["net"].dataType))


def map_accounts_default(postings: DataFrame, mapping: DataFrame, columns: list[str]) -> DataFrame:
    """Mapping row of the entity itself, else the row of the company `DEFAULT`."""
    own = mapping.where("company <> 'DEFAULT'").select(F.col("company").alias("_co"), F.col("account_code").alias("_oa"),
                                                       *[F.col(c).alias(f"_o_{c}") for c in columns])
    default = mapping.where("company = 'DEFAULT'").select(F.col("account_code").alias("_da"), *[F.col(c).alias(f"_d_{c}") for c in columns])
    return (
        postings.join(own, (F.col("entity_code") == F.col("_co")) & (F.col("account_code") == F.col("_oa")), "left")
        .join(default, F.col("account_code") == F.col("_da"), "left")
        .withColumns({**{c: F.coalesce(f"_o_{c}", f"_d_{c}") for c in columns},
                      "mapping_source": F.when(F.col("_co").isNotNull(), "ENTITY").when(F.col("_da").isNotNull(), "DEFAULT")})
        .drop("_co", "_oa", "_da", *[f"_o_{c}" for c in columns], *[f"_d_{c}" for c in columns])
    )


def quarantine_unmapped(postings: DataFrame, accounts: DataFrame) -> DataFrame:
    return postings.join(accounts.select("account_code"), "account_code", "left_anti").withColumn(
        "quarantine_reason", F.lit("UNMAPPED_ACCOUNT_CODE"))


def account_levels(node="universal_node") -> dict[str, Column]:
    parts = F.split(node, r"\.")
    return {f"level_{i}": F.get(parts, F.lit(i - 1)) for i in (1, 2, 3, 4)}


def under(prefix: str, node="universal_node") -> Column:
    return F.col(node).startswith(prefix)


def under_any(*prefixes, node="universal_node") -> Column:
    out = under(prefixes[0], node)
    for p in prefixes[1:]:
        out = out | under(p, node)
    return out
