"""Anomaly detection for all companies and months at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.periods import month_index, period_add
from .statements import KEY

KPI_COLUMNS = ["revenue", "ebitda", "ebitda_margin_pct", "gross_margin_pct", "net_profit", "current_ratio", "dso_days", "dpo_days", "net_debt_ebitda",
               "free_cash_flow"]
Z_LIMIT, BUDGET_GATE_PCT, LARGE_POSTING, VELOCITY_LIMIT, OFF_HOURS_LIMIT = 2.5, -15.0, 50_000_000, 50, 5
TREES, ROWS_PER_TREE, CONTAMINATION, SEED = 200, 256, 0.05, 42


def kpi_history(prof: DataFrame, liq: DataFrame, cash: DataFrame, current: int, months: int = 24) -> DataFrame:
    """KPI columns of the last `months` months up to the current one."""
    E = "consolidation_scope = 'entity'"
    joined = (prof.where(E).select(*KEY, "revenue", "ebitda", "ebitda_margin_pct", "gross_margin_pct", "net_profit", "revenue_variance_pct")
              .join(liq.where(E).select(*KEY, "current_ratio", "dso_days", "dpo_days", "net_debt_ebitda"), KEY, "left").join(cash.where(E).select(*KEY, "free_cash_flow"), KEY, "left"))
    return joined.where((F.col("period_key") > period_add(F.lit(current), -months)) & (F.col("period_key") <= current))


def _long(history: DataFrame, columns=KPI_COLUMNS) -> DataFrame:
    doubles = history.select(*KEY, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(KEY, list(columns), "kpi", "value").where("value IS NOT NULL")


def _severity(z):
    a = F.abs(z)
    return F.when(a > 3.5, "CRITICAL").when(a > 3.0, "HIGH").otherwise("MEDIUM")


def zscores(history: DataFrame, current: int, limit: float = Z_LIMIT) -> DataFrame:
    """Current value against mean and sample deviation of the other months; at least three values and a spread are needed."""
    rows = _long(history)
    past = rows.where(F.col("period_key") != current).groupBy("entity_key", "kpi").agg(
        F.count("*").alias("n"), F.avg("value").alias("historical_mean"), F.stddev_samp("value").alias("historical_std"))
    z = F.try_divide(F.col("value") - F.col("historical_mean"), F.col("historical_std"))
    return (rows.where(F.col("period_key") == current).join(past.where("n >= 3 AND historical_std > 1e-9"), ["entity_key", "kpi"])
            .withColumn("z_score", z).where(F.abs("z_score") > limit).withColumn("severity", _severity(F.col("z_score"))))


def zscores_rolling(history: DataFrame, window: int = 12, limit: float = Z_LIMIT) -> DataFrame:
    """Every month against its preceding twelve calendar months."""
    w = Window.partitionBy("entity_key", "kpi").orderBy(month_index("period_key")).rangeBetween(-window, -1)
    rows = _long(history).withColumns({"n": F.count("value").over(w), "m": F.avg("value").over(w), "s": F.stddev_samp("value").over(w)})
    return rows.where("n >= 3 AND s > 1e-9").withColumn("z_score", (F.col("value") - F.col("m")) / F.col("s")).where(
        F.abs("z_score") > limit).withColumn("severity", _severity(F.col("z_score"))).drop("m", "s")


def _path_lengths(x: np.ndarray, rng: np.random.Generator, trees: int, rows_per_tree: int) -> np.ndarray:
    """Mean isolation depth of each row over random axis-parallel splits."""
    sample = min(rows_per_tree, len(x))
    limit = int(np.ceil(np.log2(max(sample, 2))))
    average = lambda m: 0.0 if m <= 1 else 1.0 if m == 2 else 2.0 * (np.log(m - 1) + 0.5772156649) - 2.0 * (m - 1) / m
    total = np.zeros(len(x))
    for _ in range(trees):
        stack = [(rng.choice(len(x), sample, replace=False), np.arange(len(x)), 0)]
        while stack:
            grow, rows, depth = stack.pop()
            if len(rows) == 0:
                continue
            spread = x[grow].max(axis=0) - x[grow].min(axis=0) if len(grow) else np.zeros(x.shape[1])
            usable = np.flatnonzero(spread > 0)
            if depth >= limit or len(grow) <= 1 or len(usable) == 0:
                total[rows] += depth + average(len(grow))
                continue
            f = rng.choice(usable)
            cut = rng.uniform(x[grow, f].min(), x[grow, f].max())
            stack.append((grow[x[grow, f] < cut], rows[x[rows, f] < cut], depth + 1))
            stack.append((grow[x[grow, f] >= cut], rows[x[rows, f] >= cut], depth + 1))
    return np.power(2.0, -(total / trees) / max(average(sample), 1e-9))


def isolation_forest(history: DataFrame, current: int, trees: int = TREES, contamination: float = CONTAMINATION,
                     rows_per_tree: int = ROWS_PER_TREE) -> DataFrame:
    """Outlier verdict on the current month of each company. A group is one company's months, so its size is bounded by the history; a tree
    grows on at most `rows_per_tree` of them, and all are scored."""
    features = history.select(*KEY, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in KPI_COLUMNS])

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period_key")
        if len(pdf) < 3 or not (pdf.period_key == current).any():
            return pd.DataFrame({"entity_key": [], "period_key": [], "anomaly_score": [], "is_outlier": []})
        s = _path_lengths(pdf[KPI_COLUMNS].to_numpy(float), np.random.default_rng(SEED + int(pdf.entity_key.iloc[0])), trees, rows_per_tree)
        cut = np.quantile(s, 1 - contamination)
        out = pd.DataFrame({"entity_key": pdf.entity_key, "period_key": pdf.period_key, "anomaly_score": s, "is_outlier": s > cut})
        return out[out.period_key == current]

    return features.groupBy("entity_key").applyInPandas(score, "entity_key int, period_key int, anomaly_score double, is_outlier boolean")


def budget_gate(history: DataFrame, limit: float = BUDGET_GATE_PCT) -> DataFrame:
    return history.where(F.col("revenue_variance_pct") < limit).select(*KEY, "revenue_variance_pct")


def revenue_debits(mapped: DataFrame) -> DataFrame:
    """Income postings with a negative signed amount."""
    return mapped.where((F.col("l1_category") == "Revenue") & (F.col("signed") < 0)).groupBy("entity_key", "period_key").agg(
        F.count("*").alias("rows"), F.sum("signed").alias("total"))


def large_postings(mapped: DataFrame, limit: float = LARGE_POSTING) -> DataFrame:
    return mapped.where(F.abs("net") > limit)


def missing_accruals(movements: DataFrame, accounts: list[str], last_period: int) -> DataFrame:
    """Company, month and account for which an accrual is expected, from its first month on, but nothing was posted."""
    actual = movements.where(F.col("account_code").isin(accounts)).select("entity_key", "account_code", "period_key").distinct()
    from ..functions.periods import period_of_index
    last = (last_period // 100) * 12 + last_period % 100 - 1
    expected = actual.groupBy("entity_key", "account_code").agg(F.min(month_index("period_key")).alias("a")).select(
        "entity_key", "account_code", F.explode(F.sequence("a", F.lit(last))).alias("i")).select("entity_key", "account_code", period_of_index("i").alias("period_key"))
    return expected.join(actual, ["entity_key", "account_code", "period_key"], "left_anti")


def off_hours(postings: DataFrame, limit: int = OFF_HOURS_LIMIT, keys=("entity_key", "period_key")) -> DataFrame:
    """Postings before 07:00 or after 22:59, reported when there are more than `limit` of them."""
    outside = (F.col("posting_hour") < 7) | (F.col("posting_hour") > 22)
    return postings.where(outside).groupBy(*keys).agg(F.count("*").alias("off_hours_postings")).where(F.col("off_hours_postings") > limit)


def velocity(mapped: DataFrame, limit: int = VELOCITY_LIMIT) -> DataFrame:
    return mapped.groupBy("posting_date", "universal_node").agg(F.count("*").alias("daily_count")).where(F.col("daily_count") > limit)


EVIDENCE = ["current_value", "historical_mean", "historical_std", "z_score", "anomaly_score"]


def queue_rows(df: DataFrame, cls: str, method: str, severity, kpi, description, action, **evidence) -> DataFrame:
    """A detector's rows in the queue layout; evidence that a detector doesn't have stays null."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    return df.select("entity_key", "period_key", F.lit(cls).alias("anomaly_class"), F.lit(method).alias("detection_method"), lit(severity).alias("severity"),
                     lit(kpi).alias("kpi_affected"), lit(description).alias("description"), lit(action).alias("recommended_action"),
                     *[evidence.get(c, F.lit(None)).cast("double").alias(c) for c in EVIDENCE])


def build_queue(history: DataFrame, current: int, postings: DataFrame, mapped_movements: DataFrame, check: DataFrame, mapped: DataFrame, duplicates: DataFrame,
                large: float = LARGE_POSTING, fast: int = VELOCITY_LIMIT, with_forest: bool = True) -> DataFrame:
    """All detector results for the current month in the queue layout, every row open: one row per company and finding.

    `duplicates`: rows that share a fingerprint (see dq.duplicate_postings); `mapped`: postings with their account's node.
    """
    z = zscores(history, current)
    now = F.col("period_key") == current
    per_company = lambda df: df.where(now).groupBy("entity_key", "period_key").agg(F.count("*").alias("found"))
    busy = mapped.where(now).groupBy("entity_key", "period_key", "posting_date", "universal_node").agg(F.count("*").alias("daily_count")).where(F.col("daily_count") > fast)
    forest = isolation_forest(history, current).where("is_outlier") if with_forest else None
    review = "Review the postings"
    parts = [
        queue_rows(per_company(duplicates), "STRUCTURAL", "RULE_ENGINE", "HIGH", "DUPLICATE_POSTINGS", "Postings with the same fingerprint", review, current_value=F.col("found")),
        queue_rows(per_company(large_postings(mapped, large)), "BEHAVIOURAL", "RULE_ENGINE", "HIGH", "LARGE_POSTINGS", "Postings above the limit", review, current_value=F.col("found")),
        queue_rows(busy.groupBy("entity_key", "period_key").agg(F.max("daily_count").alias("found")), "BEHAVIOURAL", "RULE_ENGINE", "MEDIUM", "POSTING_VELOCITY",
                   "Many postings on one day and account group", review, current_value=F.col("found")),
        *([queue_rows(forest, "STATISTICAL", "ISOLATION_FOREST", "HIGH", "MULTI_KPI", "The month's KPIs together are unusual", "Review all KPIs against earlier months",
                      anomaly_score=F.col("anomaly_score"))] if with_forest else []),
        queue_rows(z, "STATISTICAL", "ZSCORE", F.col("severity"), F.col("kpi"), F.concat(F.col("kpi"), F.when(F.col("z_score") > 0, " above average").otherwise(" below average")),
                   F.concat(F.lit("Investigate "), F.col("kpi")), current_value=F.col("value"), historical_mean=F.col("historical_mean"),
                   historical_std=F.col("historical_std"), z_score=F.col("z_score")),
        queue_rows(budget_gate(history.where(F.col("period_key") == current)), "STATISTICAL", "BUDGET_GATE", "HIGH", "revenue_variance_pct", "Revenue far below budget", "Explain the variance",
                   current_value=F.col("revenue_variance_pct")),
        queue_rows(revenue_debits(mapped_movements.where(F.col("period_key") == current)), "STRUCTURAL", "RULE_ENGINE", "HIGH", "REVENUE_ACCOUNTS", "Revenue accounts with debit postings", review,
                   current_value=F.col("rows")),
        queue_rows(check.where(~F.col("is_balanced") & (F.col("period_key") == current)), "STRUCTURAL", "RULE_ENGINE", "CRITICAL", "BALANCE_SHEET_EQUATION", "Balance sheet does not balance",
                   "Stop the close and find the difference", current_value=F.col("balance_difference")),
        queue_rows(off_hours(postings.where(F.col("period_key") == current)), "BEHAVIOURAL", "RULE_ENGINE", "MEDIUM", "OFF_HOURS_POSTINGS", "Postings outside business hours", review,
                   current_value=F.col("off_hours_postings")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.lit("OPEN"))
