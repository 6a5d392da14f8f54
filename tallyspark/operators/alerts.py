"""Alert rules over KPI values, cooldown, the alerts' life cycle and summaries."""

from pyspark.sql import Column, DataFrame, functions as F

from ..plans import constants as K

LONG = ["entity_key", "period_key", "kpi_name", "value", "budget_value", "py_value"]


KPIS = ["cash_balance", "ebitda_margin_ratio", "revenue_vs_budget_ratio", "dso_days", "net_debt_ebitda", "revenue_yoy_ratio", "ebitda_vs_budget_ratio", "cash_runway_days", "revenue", "ebitda"]
OPEN, ACKNOWLEDGED, CLOSED = STATES = ["OPEN", "ACKNOWLEDGED", "CLOSED"]
LOG = ("alert_id string, rule_code string, entity_key int, entity_code string, period_key int, kpi_name string, value double, threshold double, severity string, "
       "cooldown_hours int, status string, raised_at timestamp, acknowledged_at timestamp, closed_at timestamp")


def kpi_wide(components: DataFrame, liquidity: DataFrame, cash: DataFrame) -> DataFrame:
    """The KPIs that rules may name, one row per company and month, with budget and last year's value of two of them."""
    entity, key = "consolidation_scope = 'entity'", ["period_key", "entity_key"]
    c = F.col
    return (components.select(*key, "ebitda_margin_ratio", c("revenue_variance_ratio").alias("revenue_vs_budget_ratio"), "revenue_yoy_ratio",
                              c("ebitda_variance_ratio").alias("ebitda_vs_budget_ratio"), "revenue", "ebitda", "revenue_budget", "ebitda_budget", "revenue_py", "ebitda_py")
            .join(liquidity.where(entity).select(*key, c("cash").alias("cash_balance"), "dso_days", "net_debt_ebitda"), key, "left")
            .join(cash.where(entity).select(*key, (c("cash_runway_months") * 30).alias("cash_runway_days")), key, "left"))


def kpi_long(components: DataFrame, liquidity: DataFrame, cash: DataFrame) -> DataFrame:
    """KPI values with the budget and last year's value where the KPI has one."""
    key = ["period_key", "entity_key"]
    wide = kpi_wide(components, liquidity, cash)
    base = wide.select(*key, *[F.col(f"{k}_{x}").cast("double").alias(f"{k}_{x}") for k in ("revenue", "ebitda") for x in ("budget", "py")])
    pick = lambda x: F.when(F.col("kpi_name") == "revenue", F.col(f"revenue_{x}")).when(F.col("kpi_name") == "ebitda", F.col(f"ebitda_{x}"))
    return kpi_unpivot(wide, KPIS).join(base, key).select("entity_key", "period_key", "kpi_name", "value", pick("budget").alias("budget_value"), pick("py").alias("py_value"))


def kpi_unpivot(wide: DataFrame, kpis: list[str]) -> DataFrame:
    """Wide KPI frame to one row per KPI; missing values drop out."""
    doubles = wide.select("entity_key", "period_key", *[F.col(k).cast("double").alias(k) for k in kpis])
    return doubles.unpivot(["entity_key", "period_key"], kpis, "kpi_name", "value").where("value IS NOT NULL")


def rules_by_entity(rules: DataFrame, entities: DataFrame) -> DataFrame:
    """Each rule meets the companies of its scope: every company answers to its own code and to ALL."""
    scoped = entities.select("entity_key", "entity_code", F.explode(F.array(F.lit("ALL"), F.col("entity_code"))).alias("entity_scope"))
    return rules.join(scoped, "entity_scope")


def orphan_scopes(rules: DataFrame, entities: DataFrame) -> DataFrame:
    return rules.where("entity_scope <> 'ALL'").join(entities, F.col("entity_scope") == F.col("entity_code"), "left_anti")


def breached(value: Column, operator: Column, threshold: Column) -> Column:
    tests = {"<": value < threshold, ">": value > threshold, "<=": value <= threshold, ">=": value >= threshold, "=": value == threshold, "!=": value != threshold}
    out = None
    for name, test in tests.items():
        out = F.when(operator == name, test) if out is None else out.when(operator == name, test)
    return F.coalesce(out, F.lit(False))


def scaled_threshold() -> Column:
    """A threshold is absolute or a share of the budget or of last year's value."""
    t, unit = F.col("threshold_value"), F.col("threshold_unit")
    return F.when(unit == "PCT_OF_BUDGET", t * F.col("budget_value")).when(unit == "PCT_OF_PY", t * F.col("py_value")).otherwise(t)


def evaluate(kpis: DataFrame, rules: DataFrame, entities: DataFrame) -> DataFrame:
    """Breached rules as alert rows. Rules whose KPI nobody computes match nothing (see `unmatched_rules`)."""
    scoped = rules_by_entity(rules, entities).drop("entity_code")
    hit = kpis.join(scoped, ["kpi_name", "entity_key"]).withColumn("threshold", scaled_threshold())
    return hit.where(breached(F.col("value"), F.col("operator"), F.col("threshold"))).select(
        "rule_code", "entity_key", "period_key", "kpi_name", "value", "operator", "threshold", "threshold_unit", "severity", "cooldown_hours")


def unmatched_rules(rules: DataFrame, kpis: DataFrame) -> DataFrame:
    return rules.join(kpis.select("kpi_name").distinct(), "kpi_name", "left_anti")


def after_cooldown(candidates: DataFrame, log: DataFrame) -> DataFrame:
    """Candidates without an open or acknowledged alert of the same rule and company in the cooldown before them.

    Log rows are spread over the days they cover, so the range condition becomes an equality with a residual check.
    """
    live = log.where(F.col("status").isin("OPEN", "ACKNOWLEDGED")).select(
        F.col("rule_code").alias("_r"), F.col("entity_code").alias("_e"), F.col("raised_at").alias("_t"),
        F.make_dt_interval(hours=F.col("cooldown_hours")).alias("_c"))
    live = live.withColumn("_day", F.explode(F.sequence(F.to_date("_t"), F.to_date(F.col("_t") + F.col("_c")))))
    return candidates.join(
        live, (F.col("rule_code") == F.col("_r")) & (F.col("entity_code") == F.col("_e")) & (F.to_date("raised_at") == F.col("_day"))
        & (F.col("_t") <= F.col("raised_at")) & (F.col("raised_at") < F.col("_t") + F.col("_c")), "left_anti")


def evaluate_into(log: DataFrame | None, kpis: DataFrame, rules: DataFrame, entities: DataFrame, at: Column) -> DataFrame:
    """The alert log (LOG) after the rules were evaluated at a moment: breaches fire unless their rule's cooldown still runs in the company (an alert that is
    open or acknowledged, raised less than the rule's cooldown hours ago). Several months of one rule and company may breach at once; the latest
    fires. Evaluating again at the same moment changes nothing."""
    found = evaluate(kpis, rules, entities).join(entities.select("entity_key", "entity_code"), "entity_key").withColumn("raised_at", at)
    latest = found.groupBy("rule_code", "entity_code").agg(F.max(F.struct("period_key", *[c for c in found.columns if c not in ("period_key", "rule_code", "entity_code")])).alias("a"))
    found = latest.select("rule_code", "entity_code", "a.*")
    if log is not None:
        found = after_cooldown(found, log)
        ids = log.select("alert_id")
    never = F.lit(None).cast("timestamp")
    fired = found.select(F.sha2(F.concat_ws("|", "rule_code", "entity_code", F.date_format("raised_at", "yyyyMMddHHmmss")), 256).alias("alert_id"), "rule_code", "entity_key", "entity_code", "period_key", "kpi_name",
                         F.col("value").cast("double").alias("value"), F.col("threshold").cast("double").alias("threshold"), "severity", "cooldown_hours", F.lit(OPEN).alias("status"),
                         "raised_at", never.alias("acknowledged_at"), never.alias("closed_at"))
    # an alert raised at this very moment may have been closed since: it is the same alert
    return fired if log is None else log.unionByName(fired.join(ids, "alert_id", "left_anti"))


def advance(log: DataFrame, changes: DataFrame) -> DataFrame:
    """The log after changes (alert_id, status, at): alerts go from open over acknowledged to closed, possibly at once, and never back. Of several
    changes of one alert the furthest counts, and of equal ones the first."""
    rank = lambda c: F.array_position(F.array(*[F.lit(s) for s in STATES]), c)
    step = changes.where(F.col("status").isin(ACKNOWLEDGED, CLOSED)).groupBy("alert_id").agg(
        F.min(F.when(F.col("status") == ACKNOWLEDGED, F.col("at"))).alias("_ack"), F.min(F.when(F.col("status") == CLOSED, F.col("at"))).alias("_close"))
    to = F.when(F.col("_close").isNotNull(), CLOSED).when(F.col("_ack").isNotNull(), ACKNOWLEDGED)
    rows = log.join(step, "alert_id", "left").withColumn("_to", to)
    status = F.when(rank(F.col("_to")) > rank(F.col("status")), F.col("_to")).otherwise(F.col("status"))
    return rows.select(*[c for c in log.columns if c not in ("status", "acknowledged_at", "closed_at")], status.alias("status"),
                       F.coalesce("acknowledged_at", F.when(F.col("status") == OPEN, F.col("_ack"))).alias("acknowledged_at"), F.coalesce("closed_at", "_close").alias("closed_at")).select(*log.columns)


def severity_rank(column: str = "severity") -> Column:
    out = F.when(F.col(column) == K.SEVERITIES[0], 1)
    for i, name in enumerate(K.SEVERITIES[1:], 2):
        out = out.when(F.col(column) == name, i)
    return out.otherwise(len(K.SEVERITIES) + 1)


def summary(alerts: DataFrame) -> DataFrame:
    """Open alerts per company and severity with the oldest period, most severe first."""
    return alerts.where("status = 'OPEN'").groupBy("entity_key", "severity").agg(
        F.count("*").alias("open_alerts"), F.min("period_key").alias("oldest_period")).withColumn(
        "severity_order", severity_rank()).orderBy("severity_order", "entity_key")
