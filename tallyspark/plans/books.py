"""The books of a group of companies, derived from the order tables.

Nations are the entities, regions the consolidation groups, order lines the business events. Every line posts a few balanced
legs (see LEGS). Row-level operators read `ledger`; statements read `trial_balance`, where the amounts of a line are summed per
(company, month) *before* the legs are unfolded, so the exploded ledger is never shuffled for a monthly figure.
"""

from __future__ import annotations

import threading
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.money import MILLION, amount, cents, cents_over, from_cents, millionths
from ..functions.periods import month_index, period_of_date
from ..operators import accounts as acc, fx as fx_ops, kpi, staging, statements as st
from ..session import fresh_path
from . import constants as K

AMOUNTS = [leg[6] for leg in K.LEGS]
SOURCES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
_STORE: dict[tuple, str] = {}
_LOCK = threading.RLock()


class Books:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def source_state(self) -> tuple:
        """A checksum over the source files' paths, sizes and times; contents are not read."""
        files = self.spark.read.format("binaryFile").load([f"{self.dir}/{t}.parquet" for t in SOURCES])
        parts = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        return tuple(files.agg(F.sum(parts), F.count("*")).first())

    def values(self, rows, columns) -> DataFrame:
        return K.frame(self.spark, rows, columns)

    def stored(self, name: str, build) -> DataFrame:
        """A gold table: written once for each state of the source files to the shared folder, then read with exact size statistics."""
        key = (self.spark.sparkContext.applicationId, self.dir, self.source_state, name)
        with _LOCK:
            if key not in _STORE:
                path = fresh_path(self.spark, name)
                build().write.parquet(path)
                _STORE[key] = path
            return self.spark.read.parquet(_STORE[key])

    # ---- reference data -----------------------------------------------------------------------------------------
    @cached_property
    def accounts(self) -> DataFrame:
        return self.values(K.ACCOUNTS, K.ACCOUNT_COLUMNS)

    @cached_property
    def currencies(self) -> DataFrame:
        return self.values(K.CURRENCIES, ["currency_code", "region_key", "base_rate"])

    @cached_property
    def entities(self) -> DataFrame:
        """Nations as companies: group, parent (lowest key of the region), consolidation method and share."""
        nation, region = self.t("nation"), self.t("region")
        parents = nation.groupBy(F.col("n_regionkey").alias("rk")).agg(F.min("n_nationkey").alias("parent"))
        key = F.col("n_nationkey")
        return (
            nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).join(parents, F.col("n_regionkey") == F.col("rk"))
            .select(
                key.cast("int").alias("entity_key"), F.col("n_name").alias("entity_code"),
                F.col("n_regionkey").cast("int").alias("region_key"), F.col("r_name").alias("consolidation_group"),
                F.when(key != F.col("parent"), F.col("parent").cast("int")).alias("parent_key"),
                F.when(key % 11 == 5, "EQUITY").when(key % 7 == 3, "PROPORTIONAL").otherwise("FULL").alias("method"),
                F.when(key % 11 == 5, F.lit(0.0)).when(key % 7 == 3, F.lit(0.5)).otherwise(F.lit(1.0)).alias("share"),
            )
        )

    @cached_property
    def registry(self) -> DataFrame:
        """Intercompany registry: a row per relation of each ordered pair of companies of one group that trade with each other."""
        pairs = self.stored("trading_pairs", lambda: self.base().where("is_intercompany").select("seller_key", "buyer_key").distinct())
        types = F.array(*[F.struct(F.lit(i).alias("no"), *[F.lit(v).alias(c) for c, v in zip(
            ("transaction_type", "elimination_type", "seller_account", "buyer_account"), t)]) for i, t in enumerate(K.IC_TYPES)])
        return pairs.withColumn("t", F.explode(types)).select(
            (F.col("seller_key").cast("bigint") * K.PAIR_STEP + F.col("buyer_key") * 10 + F.col("t.no")).alias("pair_id"), "seller_key", "buyer_key",
            "t.seller_account", "t.buyer_account", "t.transaction_type", "t.elimination_type",
            ((F.col("seller_key") + F.col("buyer_key")) % 9 != 0).alias("is_active"),
            F.make_date(F.lit(1995) + (F.col("seller_key") % 3), F.lit(1), F.lit(1)).alias("valid_from"),
            F.when(F.col("buyer_key") % 4 == 0, F.to_date(F.lit("1999-12-31"))).alias("valid_to"),
        )

    # ---- exchange rates -----------------------------------------------------------------------------------------
    @cached_property
    def fx_quotes(self) -> DataFrame:
        """One quote per order of a foreign customer on a weekday; USD is missing on days 100-104 of a year."""
        nation = self.t("nation").select(F.col("n_nationkey"), F.col("n_regionkey").cast("int").alias("region_key"))
        day = F.to_date("o_orderdate")
        return (
            self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
            .join(self.t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.currencies, "region_key")
            .where((F.col("currency_code") != "HUF") & (F.weekday(day) < 5))
            .where(~((F.col("currency_code") == "USD") & F.dayofyear(day).between(100, 104)))
            .select(day.alias("rate_date"), "currency_code", "o_orderkey", "base_rate")
        )

    @cached_property
    def fx_rates(self) -> DataFrame:
        """Official daily rate: the last quote of the day. Bounded by calendar days times currencies."""
        return self.stored("fx_rates", lambda: (
            self.fx_quotes.groupBy("rate_date", "currency_code", "base_rate").agg(F.max("o_orderkey").alias("k"))
            .select("rate_date", "currency_code", (
                F.col("base_rate").cast("decimal(16,6)") + (F.col("k") % 200).cast("decimal(16,6)") * F.lit("0.01").cast("decimal(4,2)")
            ).cast("decimal(16,6)").alias("rate_to_huf"))
        ))

    @cached_property
    def fx_daily(self) -> DataFrame:
        return self.stored("fx_daily", lambda: fx_ops.densify(self.fx_rates, K.AS_OF))

    # ---- postings -----------------------------------------------------------------------------------------------
    def base(self, dims: bool = False) -> DataFrame:
        """One row per order line with both parties and the amount of every leg (null where the leg does not apply)."""
        nation = self.t("nation").select(F.col("n_nationkey").cast("int").alias("k"), F.col("n_name").alias("code"),
                                         F.col("n_regionkey").cast("int").alias("r"))
        seller = nation.select(F.col("k").alias("seller_key"), F.col("code").alias("seller_code"), F.col("r").alias("seller_region"))
        buyer = nation.select(F.col("k").alias("buyer_key"), F.col("code").alias("buyer_code"), F.col("r").alias("buyer_region"))
        orders = (
            self.t("orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("document_date"), "o_orderpriority")
            .join(self.t("customer").select("c_custkey", F.col("c_nationkey").cast("int").alias("buyer_key")),
                  F.col("o_custkey") == F.col("c_custkey"))
        )
        lines = (
            self.t("lineitem")
            .join(self.t("supplier").select("s_suppkey", F.col("s_nationkey").cast("int").alias("seller_key")),
                  F.col("l_suppkey") == F.col("s_suppkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(seller, "seller_key").join(buyer, "buyer_key")
        )
        if dims:
            lines = lines.join(self.t("part").select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"), "left")
        price, tax = amount("l_extendedprice"), F.col("l_tax").cast("decimal(4,2)")
        ic = (F.col("seller_region") == F.col("buyer_region")) & (F.col("seller_key") != F.col("buyer_key"))
        lines = lines.withColumns({
            "price": price, "is_intercompany": ic, "posting_date": F.to_date("l_shipdate"),
            "net_price": amount(price * (1 - F.col("l_discount").cast("decimal(4,2)"))),
            "tax_amount": amount(price * tax),
        })
        share = lambda text: amount(F.col("price") * F.lit(text).cast("decimal(4,3)"))
        unmapped = F.col("l_partkey") % 97 == 0
        keep = [F.col("l_orderkey").alias("orderkey"), F.col("l_linenumber").alias("linenumber"), F.col("l_partkey").alias("partkey"),
                F.col("l_suppkey").alias("suppkey"), F.col("l_returnflag").alias("returnflag"), "l_linestatus", "price", "posting_date",
                "document_date", period_of_date("posting_date").alias("period_key"), "seller_key", "seller_code", "buyer_key",
                "buyer_code", "seller_region", "buyer_region", "is_intercompany"]
        if dims:
            keep += [F.col("p_type").alias("cost_centre"), F.when(F.col("l_linenumber") <= 3, F.col("p_brand")).alias("project")]
        return lines.select(
            *keep,
            F.col("net_price").alias("a_sale"), share("0.600").alias("a_cost"),
            F.when(~unmapped, F.col("tax_amount")).alias("a_other"), F.when(unmapped, F.col("tax_amount")).alias("a_unmapped"),
            amount(F.col("l_quantity").cast("decimal(10,2)") * 100).alias("a_payroll"),
            F.when(F.col("l_returnflag") == "A", share("0.020")).alias("a_depr"),
            F.when(F.col("l_returnflag") == "R", share("0.010")).alias("a_intexp"),
            F.when(F.col("l_returnflag") == "N", share("0.005")).alias("a_intinc"),
            F.when(F.col("l_linestatus") == "F", amount(F.col("net_price") * F.lit("0.03").cast("decimal(4,2)"))).alias("a_tax"),
            F.when((F.col("l_linestatus") == "F") & ~F.col("is_intercompany"),
                   amount(F.col("net_price") * F.lit("0.80").cast("decimal(4,2)"))).alias("a_receipt"),
            F.when(F.col("o_orderpriority") == "1-URGENT", share("0.050")).alias("a_capex"),
            share("0.700").alias("a_goods"),
            F.when(F.col("is_intercompany"), F.col("net_price")).alias("a_icbuy"),
        )

    def ledger(self, dims: bool = False, accounts: list[str] | None = None, on_lines=None) -> DataFrame:
        """Posting lines: every leg of every order line, one debit and one credit row.

        With `accounts` only the templates that can post to them are unfolded, and only their rows come back. `on_lines` may add columns to the
        order lines, which their postings then carry. What a line's or a leg's postings share is worked out before these are unfolded.
        """
        ic = F.col("is_intercompany")
        templates = [t for t in K.LEGS if accounts is None or set(t[2:6]) & set(accounts)]
        legs = F.array(*[
            F.struct(
                F.lit(leg).alias("leg"),
                F.col(f"{poster}_key").alias("entity_key"), F.col(f"{poster}_code").alias("entity_code"),
                F.col("buyer_key" if poster == "seller" else "seller_key").alias("counterparty_key"),
                F.when(ic, debit_ic).otherwise(debit).alias("debit_account"),
                F.when(ic, credit_ic).otherwise(credit).alias("credit_account"),
                F.col(amt).alias("amt"),
            ) for leg, poster, debit, credit, debit_ic, credit_ic, amt in templates
        ])
        zero = F.lit(0).cast("decimal(18,2)")
        source_id = F.concat_ws("-", "orderkey", "linenumber")
        lines = self.base(dims).join(self.currencies.select(F.col("region_key").alias("buyer_region"), "currency_code", "base_rate"), "buyer_region").withColumns({
            "source_id": source_id, "line_id": F.concat_ws("-", source_id, "partkey", "suppkey"),
            "ingestion_date": F.date_add("posting_date", (F.col("partkey") % 40).cast("int")),
            "posting_hour": (F.col("partkey") % 24).cast("int"), "document_number": F.col("orderkey").cast("string"),
            "source_system": F.element_at(F.array(*[F.lit(s) for s in K.SOURCE_SYSTEMS]), (F.col("suppkey") % 3 + 1).cast("int")),
            "is_reversal": (F.col("returnflag") == "R") & (F.col("linenumber") == 7),
        })
        added = []
        if on_lines is not None:
            known, lines = set(lines.columns), on_lines(lines)
            added = [c for c in lines.columns if c not in known]
        of_line = ["source_id", "posting_date", "document_date", "ingestion_date", "period_key", "posting_hour", "document_number", "source_system",
                   "currency_code", "is_intercompany", "is_reversal", "partkey", *(["cost_centre", "project"] if dims else []), *added]
        of_leg = ["leg", "entity_key", "entity_code", "counterparty_key"]
        posted = (
            lines.select(*of_line, "line_id", "base_rate", F.explode(legs).alias("x")).where("x.amt IS NOT NULL")
            .select(*of_line, *[f"x.{c}" for c in of_leg], "x.amt", F.concat_ws("-", "line_id", "x.leg").alias("leg_id"),
                    F.concat_ws("-", "period_key", "x.entity_code").alias("batch_id"), fx_ops.over("x.amt", "base_rate").alias("fcy"),
                    "x.debit_account", "x.credit_account")
        )
        unfolded = posted.select(*of_line, *of_leg, "amt", "leg_id", "batch_id", "fcy", F.explode(F.array(
            F.struct(F.lit("D").alias("side"), F.lit(True).alias("is_debit"), F.col("debit_account").alias("account_code")),
            F.struct(F.lit("C").alias("side"), F.lit(False).alias("is_debit"), F.col("credit_account").alias("account_code")),
        )).alias("y"))
        if accounts is not None:
            unfolded = unfolded.where(F.col("y.account_code").isin(accounts))
        on_debit = lambda value, other: F.when(F.col("y.is_debit"), value).otherwise(other)
        return unfolded.select(
            F.concat_ws("-", "leg_id", "y.side").alias("transaction_id"), "source_id",
            "leg", F.col("y.side").alias("side"), "entity_key", "entity_code", "counterparty_key",
            F.col("y.account_code").alias("account_code"), on_debit(F.col("amt"), zero).alias("debit"), on_debit(zero, F.col("amt")).alias("credit"),
            on_debit(F.col("amt"), -F.col("amt")).cast("decimal(18,2)").alias("net"),
            "posting_date", "document_date", "ingestion_date", "period_key", "posting_hour", "document_number", "batch_id", "source_system",
            "currency_code", on_debit(F.col("fcy"), zero).alias("debit_fcy"), on_debit(zero, F.col("fcy")).alias("credit_fcy"),
            "is_intercompany", "is_reversal", "partkey", *(["cost_centre", "project"] if dims else []), *added,
        )

    def movements(self, dims: list[str] = (), with_eur: bool = True) -> DataFrame:
        """Monthly sums per (entity, account, intercompany flag[, dims]) without ever shuffling exploded postings."""
        base = self.base(bool(dims))
        eur = self.fx_rates.where("currency_code = 'EUR'").select(
            F.col("rate_date").alias("posting_date"), millionths("rate_to_huf").alias("per_eur"))
        base = base.join(eur, "posting_date", "left").withColumn("per_eur", F.coalesce("per_eur", F.lit(fx_ops.EUR_FALLBACK * MILLION).cast("bigint")))
        # sums are of whole cents: 64-bit additions instead of wide decimals
        base = base.withColumns({a: cents(a) for a in AMOUNTS})
        in_eur = lambda a: cents_over(F.col(a), F.col("per_eur"))
        # one row per posting company of a line: the seller with its legs, and the buyer of an intercompany line with the mirrored leg
        of = {poster: [leg[6] for leg in K.LEGS if leg[1] == poster] for poster in ("seller", "buyer")}
        nothing = F.lit(None).cast("bigint")
        party = lambda poster: F.struct(F.col(f"{poster}_key").alias("entity_key"), *[
            (F.col(a) if a in of[poster] else nothing).alias(a) for a in AMOUNTS])
        parties = F.when(F.col("is_intercompany"), F.array(party("seller"), party("buyer"))).otherwise(F.array(party("seller")))
        rows = base.select("period_key", "is_intercompany", "per_eur", *dims, F.explode(parties).alias("p")).select(
            "period_key", "is_intercompany", "per_eur", *dims, "p.*")
        sums = []
        for a in AMOUNTS:
            sums += [F.sum(a).alias(a), F.count(a).alias(f"n_{a}"), F.sum(in_eur(a)).alias(f"e_{a}")]
        keys = ["entity_key", "period_key", "is_intercompany", *dims]
        per_month = rows.groupBy(*keys).agg(*sums)
        ic = F.col("is_intercompany")
        zero = F.lit(0).cast("decimal(28,2)")
        legs = []
        for _, _, debit, credit, debit_ic, credit_ic, a in K.LEGS:
            value, eur_value = from_cents(a, "decimal(28,2)"), from_cents(f"e_{a}", "decimal(28,2)")
            for side, account, account_ic in (("D", debit, debit_ic), ("C", credit, credit_ic)):
                legs.append(F.struct(
                    F.when(ic, account_ic).otherwise(account).alias("account_code"),
                    (value if side == "D" else zero).alias("debit"), (value if side == "C" else zero).alias("credit"),
                    (eur_value if side == "D" else (-eur_value).cast("decimal(28,2)")).alias("net_eur"), F.col(f"n_{a}").alias("postings")))
        # the unfolded legs keep the grouping of the months, so the last sum needs no further shuffle
        return (
            per_month.select(*keys, F.explode(F.array(*legs)).alias("r")).where("r.postings > 0")
            .groupBy(*keys, "r.account_code")
            .agg(F.sum("r.debit").cast("decimal(28,2)").alias("debit"), F.sum("r.credit").cast("decimal(28,2)").alias("credit"),
                 F.sum("r.net_eur").cast("decimal(28,2)").alias("net_eur"), F.sum("r.postings").alias("postings"))
            .withColumn("net", (F.col("debit") - F.col("credit")).cast("decimal(28,2)"))
        )

    @cached_property
    def trial_balance(self) -> DataFrame:
        return self.stored("trial_balance", self.movements)

    @cached_property
    def cost_balance(self) -> DataFrame:
        """Monthly movements by cost centre and project."""
        return self.stored("cost_balance", lambda: self.movements(["cost_centre", "project"]))

    @cached_property
    def project_balance(self) -> DataFrame:
        """Monthly movements by project alone: sums of cents, so they are those of `cost_balance` added up, from far fewer groups."""
        return self.stored("project_balance", lambda: self.movements(["project"]))

    # ---- balance sheet and budget uploads -----------------------------------------------------------------------
    @cached_property
    def balance_upload(self) -> DataFrame:
        """Month-end balances per entity and account (debits minus credits) on a gap-free month grid up to the closing date.

        Profit-and-loss accounts collapse into 419, so the sheet balances; 382 is off by 1000 in some months on purpose.
        """
        account = F.when(F.substring("account_code", 1, 1).isin("1", "2", "3", "4"), F.col("account_code")).otherwise(F.lit("419"))
        moves = self.trial_balance.groupBy("entity_key", account.alias("account_code"), month_index("period_key").alias("mi")).agg(
            F.sum("net").cast("decimal(28,2)").alias("movement"))
        last = AS_OF_INDEX
        grid = moves.groupBy("entity_key", "account_code").agg(F.min("mi").alias("first")).select(
            "entity_key", "account_code", F.explode(F.sequence(F.col("first"), F.lit(last))).alias("mi"))
        run = Window.partitionBy("entity_key", "account_code").orderBy("mi").rowsBetween(Window.unboundedPreceding, 0)
        month = F.col("mi") % 12 + 1
        return (
            grid.join(moves, ["entity_key", "account_code", "mi"], "left").fillna(0, ["movement"])
            .withColumn("closing", F.sum("movement").over(run))
            .select(
                "entity_key", F.floor(F.col("mi") / 12).cast("int").alias("period_year"), month.cast("int").alias("period_month"),
                "account_code",
                (F.col("closing") + F.when((F.col("account_code") == "382") & ((F.col("entity_key") + month) % 17 == 0), 1000)
                 .otherwise(0)).cast("decimal(28,2)").alias("closing_balance"),
                (F.col("closing") - F.col("movement")).cast("decimal(28,2)").alias("opening_balance"),
            )
        )

    @cached_property
    def budget_upload(self) -> DataFrame:
        """Last year's income and cost per account as three budget versions under changing version names."""
        signed = self.trial_balance.join(self.accounts, "account_code").where(F.col("l1_category").isin("Revenue", "COGS", "OPEX"))
        per = signed.groupBy("entity_key", "account_code", "l1_category", (F.col("period_key") + 100).cast("int").alias("period_key")).agg(
            F.sum(F.when(F.col("l1_category") == "Revenue", -F.col("net")).otherwise(F.col("net"))).cast("decimal(28,2)").alias("py"))
        parity = (F.col("entity_key") + F.col("period_key") % 100) % 2 == 0
        unit_error = (F.col("entity_key") + F.col("period_key") % 100) % 13 == 0
        dec = lambda text: F.lit(text).cast("decimal(8,5)")
        version = lambda a, b, f: F.struct(F.when(parity, a).otherwise(b).alias("budget_version"), dec(f).alias("f"))
        return (
            per.withColumn("v", F.explode(F.array(version("BUDGET", "original_budget", "1.05"), version("Revised", "REVISED_BUDGET", "1.02"),
                                                  version("FORECAST", "rolling_forecast", "0.98"))))
            .select("entity_key", F.floor(F.col("period_key") / 100).cast("int").alias("period_year"),
                    (F.col("period_key") % 100).cast("int").alias("period_month"), "account_code", "v.budget_version",
                    (F.col("py") * F.when(unit_error, (F.col("v.f") * dec("0.001")).cast("decimal(8,5)")).otherwise(F.col("v.f"))).cast("decimal(28,2)").alias("budget_amount"))
        )

    # ---- statements ---------------------------------------------------------------------------------------------
    @cached_property
    def mapped(self) -> DataFrame:
        return acc.map_accounts(self.trial_balance, self.accounts)

    @cached_property
    def budget(self) -> DataFrame:
        return staging.stage_budget(self.budget_upload)

    @cached_property
    def budget_lines(self) -> DataFrame:
        return st.budget_by_line(self.budget, self.accounts)

    def build_nodes(self) -> DataFrame:
        return st.balance_sheet_nodes(staging.stage_balance_sheet(self.balance_upload), self.accounts)

    def build_pl(self) -> DataFrame:
        return st.pl_monthly(st.pl_actuals(self.mapped), self.budget_lines)

    def build_components(self) -> DataFrame:
        return st.pl_components(self.mapped, self.budget_lines)

    def build_cashflow(self) -> DataFrame:
        return st.cashflow_indirect(self.pl, st.cashflow_movements(self.nodes))

    # gold tables: one row per month and entity (or node), read by every ratio
    @cached_property
    def nodes(self) -> DataFrame:
        return self.stored("balance_sheet", self.build_nodes)

    @cached_property
    def pl(self) -> DataFrame:
        return self.stored("pl_monthly", self.build_pl)

    @cached_property
    def components(self) -> DataFrame:
        return self.stored("pl_components", self.build_components)

    @cached_property
    def cashflow(self) -> DataFrame:
        return self.stored("cashflow", self.build_cashflow)

    @cached_property
    def wide(self) -> DataFrame:
        return st.balance_sheet_wide(self.nodes)

    @cached_property
    def buckets(self) -> DataFrame:
        return st.bs_buckets(self.nodes)

    @cached_property
    def profitability(self) -> DataFrame:
        return kpi.profitability(self.pl, self.buckets)

    @cached_property
    def liquidity(self) -> DataFrame:
        return kpi.liquidity(self.buckets, self.pl, self.cashflow)

    @cached_property
    def cash_kpis(self) -> DataFrame:
        return kpi.cash_kpis(self.cashflow, self.pl, self.buckets)

    @cached_property
    def calendar(self) -> DataFrame:
        """Fiscal calendar: months with postings per entity; odd entities closed their books one year earlier."""
        return self.trial_balance.select("entity_key", "period_key").distinct().withColumn(
            "is_closed", F.col("period_key") < K.CLOSED_BEFORE - (F.col("entity_key") % 2) * 100)

    # ---- access -------------------------------------------------------------------------------------------------
    @cached_property
    def access_log(self) -> DataFrame:
        return self.t("events").select("event_id", F.col("ts").cast("timestamp").alias("event_ts"), F.col("user_id").cast("long").alias("user_id"),
                                       F.col("event_type").alias("action"), "value", "props")

    @cached_property
    def user_map(self) -> DataFrame:
        """User u may see the entities with entity_key % 5 = u % 5; every tenth user is switched off."""
        users = self.t("events").select(F.col("user_id").cast("long").alias("user_id")).distinct()
        return users.withColumn("slot", F.col("user_id") % 5).join(
            self.entities.select("entity_key", "entity_code", (F.col("entity_key") % 5).cast("long").alias("slot")), "slot"
        ).select("user_id", "entity_key", "entity_code", (F.col("user_id") % 10 != 0).alias("is_active"),
                 F.when(F.col("user_id") % 3 == 0, "CEO").when(F.col("user_id") % 3 == 1, "CFO").otherwise("AUDITOR").alias("role"))


AS_OF_INDEX = (K.AS_OF_PERIOD // 100) * 12 + K.AS_OF_PERIOD % 100 - 1
