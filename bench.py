"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line. Each query runs to the end into Spark's no-op sink.

Monthly tables that many queries share (trial balance, statements) are written once per application, like in a close run; the time
for that is reported under `gold_tables` and is part of the total.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["trial_balance", "cost_balance", "pl_monthly", "pl_monthly_ddl", "balance_sheet_nodes", "cashflow_indirect", "kpi_profitability", "kpi_liquidity",
            "kpi_cashflow", "kpi_project", "variance_analysis", "measures_by_period", "stage_gl", "map_accounts", "fx_exact_date", "fx_asof",
            "ic_flag_transactions", "resolve_dimensions", "consolidated_pl", "dq_log", "dq_duplicate_postings", "alert_evaluate", "scd2_snapshot",
            "restatement_log", "anomaly_zscore", "anomaly_velocity", "forecast_seasonal", "variance_fact_pack", "schema_doc_knn"]


def main():
    from tallyspark import catalog
    from tallyspark.plans.books import Books
    from tallyspark.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session("tallyspark-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": str(2 * int(cpus) if cpus.isdigit() else 16), "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = catalog.queries(), {}
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()

    def timed(name, action):
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    def gold():
        b = Books(spark, sf_dir)
        for table in (b.fx_rates, b.fx_daily, b.trial_balance, b.cost_balance, b.pl, b.components, b.nodes, b.cashflow):
            table.schema

    timed("gold_tables", gold)
    for name in only or HEADLINE:
        timed(name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}))


if __name__ == "__main__":
    main()
