"""Period helpers as session SQL functions, so that plain SQL users share the definitions."""

from pyspark.sql import SparkSession

DEFINITIONS = {
    "tally_prior_period(p INT) RETURNS INT": "CASE WHEN p % 100 = 1 THEN p - 89 ELSE p - 1 END",
    "tally_prior_year(p INT) RETURNS INT": "p - 100",
    "tally_period_end(p INT) RETURNS DATE": "last_day(make_date(p DIV 100, p % 100, 1))",
    "tally_valid_period(p INT) RETURNS BOOLEAN": "coalesce(p BETWEEN 200001 AND 209912 AND p % 100 BETWEEN 1 AND 12, false)",
    "tally_period_add(p INT, n INT) RETURNS INT":
        "CAST(((p DIV 100) * 12 + p % 100 - 1 + n) DIV 12 * 100 + ((p DIV 100) * 12 + p % 100 - 1 + n) % 12 + 1 AS INT)",
    "tally_fiscal_year(d DATE, m INT) RETURNS INT": "year(d) - CASE WHEN month(d) < m THEN 1 ELSE 0 END",
    "tally_fiscal_period(d DATE, m INT) RETURNS INT": "(month(d) - m + 12) % 12 + 1",
    "tally_valid_code(c STRING) RETURNS BOOLEAN": "coalesce(c RLIKE '^[A-Za-z0-9_-]{1,50}$', false)",
}


def register_sql(spark: SparkSession) -> list[str]:
    for head, body in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [head.split("(")[0] for head in DEFINITIONS]
