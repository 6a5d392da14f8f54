"""Group view: subtotals, eliminations, consolidation methods, statutory lines."""

from pyspark.sql import DataFrame, functions as F

from ..functions.money import ratio, rnd, sum_where


def statutory_lines(mapped: DataFrame) -> DataFrame:
    """Totals per statutory line; intercompany accounts are reconciled elsewhere and left out."""
    parts = F.split("universal_node", r"\.")
    line = F.when(F.col("account_type").isin("Revenue", "Expense"), F.concat(F.lit("PL."), "l1_category")).otherwise(
        F.concat(F.lit("BS."), parts[0], F.lit("."), parts[1]))
    return mapped.where(~F.col("is_ic_account")).groupBy("period_key", "entity_key", line.alias("statutory_line")).agg(F.sum("net").alias("total"))


def opening_balance_split(movements: DataFrame, balances: DataFrame, year: int) -> DataFrame:
    """Carry-forward rows count in the closing balance but not in the movement."""
    moves = movements.where(F.floor(F.col("period_key") / 100) == year).select("entity_key", "account_code", "net", F.lit(False).alias("is_opening"))
    opening = balances.where((F.col("period_year") == year - 1) & (F.col("period_month") == 12)).select(
        "entity_key", "account_code", F.col("closing_balance").alias("net"), F.lit(True).alias("is_opening"))
    return moves.unionByName(opening).groupBy("entity_key", "account_code").agg(
        sum_where(~F.col("is_opening"), "net").alias("movement"), F.sum("net").alias("closing"))


def entity_subtotals(pl: DataFrame, entities: DataFrame) -> DataFrame:
    named = pl.join(entities.select("entity_key", "entity_code", "consolidation_group"), "entity_key")
    return named.rollup("consolidation_group", "entity_code").agg(
        F.grouping_id().alias("level"), F.sum("revenue").alias("revenue"), F.sum("net_profit").alias("net_profit"),
    ).select(F.when(F.col("level") == 3, "ALL").otherwise(F.col("consolidation_group")).alias("consolidation_group"),
             F.when(F.col("level") >= 1, "TOTAL").otherwise(F.col("entity_code")).alias("entity_code"), "level", "revenue", "net_profit")


#: Per elimination type: what the seller's and the buyer's side are called, and the sign that makes a posting's net a positive amount.
SIDES = {"REVENUE_EXPENSE": (("Revenue", -1), ("COGS", 1)), "RECEIVABLE_PAYABLE": (("Receivable", 1), ("Payable", -1)),
         "INVESTMENT_EQUITY": (("Investment", 1), ("Equity", -1))}


def _sides(registry: DataFrame) -> DataFrame:
    """Active relations as (entity, account, counterparty) rows. Of relations with the same accounts the first counts, so a posting matches one."""
    def of(side, key, account, other):
        of_type = lambda k: F.create_map(*[F.lit(x) for t, names in SIDES.items() for x in (t, names[side][k])])[F.col("elimination_type")]
        return F.struct(F.col(key).alias("entity_key"), F.col(account).alias("account_code"), F.col(other).alias("counterparty_key"),
                        F.lit(side).alias("side_no"), of_type(0).alias("pl_line_item"), of_type(1).alias("sign"))

    both = F.array(of(0, "seller_key", "seller_account", "buyer_key"), of(1, "buyer_key", "buyer_account", "seller_key"))
    named = ["pair_id", "seller_key", "buyer_key", "transaction_type", "elimination_type"]
    rows = registry.where("is_active").select(F.struct(*named).alias("r"), F.explode(both).alias("s"))
    keys = ["entity_key", "account_code", "counterparty_key"]
    return rows.groupBy(*[F.col(f"s.{k}").alias(k) for k in keys]).agg(F.min(F.struct("r", "s")).alias("m")).select(
        *keys, *[F.col(f"m.r.{c}").alias(c) for c in named], "m.s.side_no", "m.s.pl_line_item", "m.s.sign")


def ic_eliminations(ledger: DataFrame, registry: DataFrame) -> DataFrame:
    """Amount to eliminate per month, relation and side. Postings are summed per (company, account, counterparty) before they meet the registry."""
    keys = ["entity_key", "account_code", "counterparty_key"]
    monthly = ledger.groupBy("period_key", *keys).agg(F.sum("net").alias("net"), F.count("*").alias("postings"))
    return monthly.join(_sides(registry), keys).groupBy("period_key", "pair_id", "seller_key", "buyer_key", "transaction_type", "elimination_type", "pl_line_item").agg(
        F.sum(F.col("net") * F.col("sign")).alias("eliminated_amount"), F.sum("postings").alias("postings"))


def consolidated_pl(pl: DataFrame, entities: DataFrame, eliminations: DataFrame) -> DataFrame:
    group = entities.select("entity_key", "consolidation_group")
    keys = ["period_key", "consolidation_group"]
    gross = pl.where("consolidation_scope = 'entity'").join(group, "entity_key").groupBy(*keys).agg(
        F.countDistinct("entity_key").alias("entity_count"), *[F.sum(x).alias(x) for x in ("revenue", "cogs", "opex_total", "net_profit")])
    line = F.col("pl_line_item")
    eliminations = eliminations.where("elimination_type = 'REVENUE_EXPENSE'")
    elim = eliminations.join(group, F.col("seller_key") == F.col("entity_key")).groupBy(*keys).agg(
        sum_where(line == "Revenue", "eliminated_amount").alias("ic_revenue"), sum_where(line == "COGS", "eliminated_amount").alias("ic_cogs"),
        F.countDistinct("pair_id").alias("pair_count"))
    j = gross.join(elim, keys, "left").fillna(0, ["ic_revenue", "ic_cogs", "pair_count"])
    revenue, cogs = F.col("revenue") - F.col("ic_revenue"), F.col("cogs") - F.col("ic_cogs")
    return j.select(*keys, "entity_count", "pair_count", F.col("revenue").alias("gross_revenue"), F.col("ic_revenue").alias("ic_revenue_eliminated"),
                    revenue.alias("consolidated_revenue"), cogs.alias("consolidated_cogs"), "opex_total", "net_profit",
                    ratio(revenue - cogs, revenue, 4, 100).alias("gross_margin_pct"))


def consolidation_by_method(pl: DataFrame, entities: DataFrame) -> DataFrame:
    """Full companies count whole, proportional ones by share; equity-method companies stay out."""
    weighted = lambda c, w: rnd(F.col(c).cast("double") * w, 2)
    share = F.col("share")
    j = pl.where("consolidation_scope = 'entity'").join(entities.where("method <> 'EQUITY'"), "entity_key")
    minority = F.when(F.col("method") == "PROPORTIONAL", weighted("net_profit", 1 - share)).otherwise(F.lit(0.0))
    return j.groupBy("period_key", "consolidation_group", "method").agg(
        F.count("*").alias("entities"), F.round(F.sum(weighted("revenue", share)), 2).alias("consolidated_revenue"),
        F.round(F.sum(weighted("net_profit", share)), 2).alias("consolidated_net_profit"), F.round(F.sum(minority), 2).alias("minority_interest"))


def ic_pair_completeness(ledger: DataFrame, registry: DataFrame, tolerance: float = 1.0) -> DataFrame:
    """Whether both sides of each active relation are posted, and by the same amount."""
    amount = lambda side: F.sum(F.when(F.col("side_no") == side, F.col("eliminated_amount")))
    sides = _sides(registry).select("pair_id", "pl_line_item", "side_no")
    totals = ic_eliminations(ledger, registry).join(sides, ["pair_id", "pl_line_item"]).groupBy("pair_id").agg(amount(0).alias("sold"), amount(1).alias("bought"))
    j = registry.where("is_active").join(totals, "pair_id", "left")
    both = F.col("sold").isNotNull() & F.col("bought").isNotNull()
    none = F.col("sold").isNull() & F.col("bought").isNull()
    zero = F.lit(0).cast("decimal(28,2)")
    return j.select(
        "pair_id", "transaction_type", F.coalesce("sold", zero).alias("sold"), F.coalesce("bought", zero).alias("bought"),
        (F.col("sold").isNotNull().cast("int") + F.col("bought").isNotNull().cast("int")).alias("sides_present"),
        F.when(both & (F.abs(F.col("sold") - F.col("bought")) < tolerance), "OK").when(none, "NO_ACTIVITY").otherwise("OUT_OF_BALANCE").alias("status"))
