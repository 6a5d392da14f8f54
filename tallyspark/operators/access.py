"""Row and column level access, access reviews, and ordered cuts."""

from pyspark.sql import DataFrame, Window, functions as F

PII = {"user_id": ["AUDITOR"], "props": ["AUDITOR", "CEO"]}


def entity_scope(df: DataFrame, user_map: DataFrame, user_id: int, entity_key: int | None = None) -> DataFrame:
    """Rows of the entities a user is actively mapped to, optionally of one of them."""
    allowed = user_map.where((F.col("user_id") == user_id) & F.col("is_active")).select("entity_key")
    scoped = df.join(allowed, "entity_key", "left_semi")
    return scoped if entity_key is None else scoped.where(F.col("entity_key") == entity_key)


def user_views(df: DataFrame, user_map: DataFrame, users: list[int]) -> DataFrame:
    """What each of the users may see, side by side."""
    views = user_map.where("is_active").where(F.col("user_id").isin(users)).select("user_id", "entity_key").distinct()
    return df.join(views, "entity_key")


def group_scope(df: DataFrame, user_map: DataFrame, entities: DataFrame, user_id: int, role: str = "CEO") -> DataFrame:
    """A group head sees every entity of the own consolidation groups."""
    own = user_map.where((F.col("user_id") == user_id) & F.col("is_active") & (F.col("role") == role)).select("entity_key")
    groups = entities.join(own, "entity_key", "left_semi").select("consolidation_group").distinct()
    visible = entities.join(groups, "consolidation_group", "left_semi").select("entity_key")
    return df.join(visible, "entity_key", "left_semi")


def cost_centre_scope(df: DataFrame, assignments: DataFrame) -> DataFrame:
    return df.join(assignments.select("cost_centre").distinct(), "cost_centre", "left_semi")


def auditor_scope(df: DataFrame, entity_keys: list[int], expires: str, as_of: str) -> DataFrame:
    """Listed entities until the mandate ends; nothing afterwards."""
    return df.where(F.col("entity_key").isin(entity_keys) & (F.to_date(F.lit(as_of)) <= F.to_date(F.lit(expires))))


def mask_columns(df: DataFrame, role_column: str = "role") -> DataFrame:
    return df.withColumns({c: F.when(~F.col(role_column).isin(roles), F.col(c)) for c, roles in PII.items()})


def tenant_scope(fact: DataFrame, entities: DataFrame, tenant: str) -> DataFrame:
    """The tenant predicate sits on the entity dimension and reaches the fact through its key."""
    return fact.join(entities.where(F.col("consolidation_group") == tenant).select("entity_key"), "entity_key", "left_semi")


class ForeignKeys:
    """A graph of tables: a predicate on one table is carried to every table that reaches it over foreign keys.

    `keys`: (table, columns, parent table, parent columns). A table is scoped by a semi-join to its scoped parent, so a fact without a company column is scoped
    through as many hops as it takes; of several ways the shortest counts, and of equally short ones all.
    """

    def __init__(self, keys: list[tuple[str, list[str], str, list[str]]]):
        self.keys = keys

    def scoped(self, tables: dict[str, DataFrame], root: str, predicate) -> dict[str, DataFrame]:
        """Each of the tables that reaches `root`, with the rows that belong to the root's rows under the predicate."""
        out, edge = {root: tables[root].where(predicate)}, {root}
        while edge:
            found: dict[str, DataFrame] = {}
            for table, columns, parent, parents in self.keys:
                if parent in edge and table not in out and table in tables:
                    allowed = out[parent].select(*[F.col(p).alias(f"_{i}") for i, p in enumerate(parents)]).distinct()
                    match = [F.col(c) == F.col(f"_{i}") for i, c in enumerate(columns)]
                    found[table] = found.get(table, tables[table]).join(allowed, match, "left_semi")
            out |= found
            edge = set(found)
        return out


def membership_diff(current: DataFrame, target: DataFrame) -> DataFrame:
    return target.subtract(current).withColumn("change", F.lit("ADD")).unionByName(
        current.subtract(target).withColumn("change", F.lit("REMOVE")))


def access_review(log: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    end = F.to_timestamp(F.lit(as_of))
    window = log.where((F.col("event_ts") >= end - F.expr(f"INTERVAL {days} DAY")) & (F.col("event_ts") < end))
    return window.groupBy("user_id", "action").agg(F.count("*").alias("actions"), F.to_date(F.min("event_ts")).alias("first_day"),
                                                   F.to_date(F.max("event_ts")).alias("last_day"))


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int, out: str = "place", ties: bool = True) -> DataFrame:
    """Rank inside a group; Spark keeps only k rows per group and task before the shuffle. Without ties exactly k rows stay."""
    place = F.rank() if ties else F.row_number()
    return df.withColumn(out, place.over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(out) <= k)


def reconcile(b, k: int = 100, tolerance: float = 0.001) -> DataFrame:
    """Ledger totals against the uploaded year-end balances, largest accounts first."""
    account = F.when(F.substring("account_code", 1, 1).isin("1", "2", "3", "4"), F.col("account_code")).otherwise(F.lit("419"))
    gold = b.trial_balance.groupBy("entity_key", account.alias("account_code")).agg(F.sum("net").alias("gold_balance"))
    master = b.balance_upload.where("period_year = 2001 AND period_month = 12").select("entity_key", "account_code", F.col("closing_balance").alias("master_balance"))
    zero = F.lit(0).cast("decimal(38,2)")
    difference = F.coalesce("gold_balance", zero) - F.coalesce("master_balance", zero)
    return gold.join(master, ["entity_key", "account_code"], "full").select(
        "entity_key", "account_code", "gold_balance", "master_balance", difference.cast("decimal(38,2)").alias("difference"),
        F.coalesce(F.abs(difference) <= F.abs("master_balance") * F.lit("0.001").cast("decimal(4,3)"), F.lit(False)).alias("within_tolerance"),
    ).orderBy(F.abs(F.coalesce("gold_balance", zero)).desc(), "entity_key", "account_code").limit(k)
