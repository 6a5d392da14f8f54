"""The shape of plans that must hold at any size."""

import re

import pytest

from tallyspark import catalog
from tests.conftest import SF

KEYS = ["trial_balance", "map_accounts", "fx_asof", "fx_availability_range", "ic_flag_transactions", "ic_flag_effective_dated", "late_flag_closed_period",
        "alert_cooldown", "alert_evaluate", "rule_entity_cross", "scd2_snapshot", "dq_log", "variance_analysis"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_nested_loops_even_without_broadcast(spark, key):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(catalog.queries()[key](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p and "BatchEvalPython" not in p


def test_columns_and_filters_reach_the_scan(spark, books):
    p = plan(books.base().select("period_key", "a_sale"))
    schema = re.search(r"ReadSchema: struct<([^>]*l_extendedprice[^>]*)>", p).group(1)
    assert "l_tax" not in schema and "l_quantity" not in schema
    assert "PushedFilters: [IsNotNull(l_" in p


def test_postings_are_not_shuffled_for_monthly_figures(spark, books):
    p = plan(books.movements())
    after_unfold = p.split("Generate explode(array(")[0]
    assert after_unfold.count("Exchange") <= 1


def test_lines_meet_orders_without_a_hint(spark, books):
    """Neither side has to fit into memory: Spark sorts and spills, or chooses by size."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(books.base())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" not in p and "SortMergeJoin" in p


def test_project_results_have_no_groups_of_cost_centres(spark, books):
    from tallyspark.operators import project
    balance = books.project_balance
    assert "cost_centre" not in balance.columns
    of = lambda b: sorted(map(tuple, project.project_actuals(b, books.accounts).collect()))
    assert of(balance) == of(books.cost_balance)
    assert balance.count() < books.cost_balance.count()


def test_postings_are_added_up_before_they_meet_their_versions(spark, monkeypatch):
    """One fact per company, account and day is looked up, not one per posting."""
    from tallyspark.operators import history
    asked = []
    looked_up = history.valid_at
    monkeypatch.setattr(history, "valid_at", lambda facts, *rest: asked.append(facts) or looked_up(facts, *rest))
    catalog.queries()["temporal_mapping_join"](spark, SF)
    key = ["company", "account_code", "posting_date"]
    assert asked[0].count() == asked[0].select(*key).distinct().count()


def unfolded_last(df):
    """The optimised plan above and below the unfolding of order lines into legs and sides."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [i for i, line in enumerate(lines) if "Generate explode(" in line]
    return "\n".join(lines[:at[0]]), "\n".join(lines[at[0]:at[-1]]), "\n".join(lines[at[-1] + 1:])


def test_what_the_postings_of_a_line_share_is_worked_out_before_they_are_unfolded(spark, books):
    sides, legs, lines = unfolded_last(books.ledger().select("transaction_id", "ingestion_date", "document_number", "source_system", "currency_code", "debit_fcy"))
    assert "Join" not in sides + legs and "Join" in lines
    assert "date_add" not in sides + legs and "date_add" in lines
    assert "concat_ws(-, cast(" not in sides + legs
    assert "base_rate" not in sides


def test_centre_project_currency_and_date_are_looked_up_for_the_line(spark, books):
    from tallyspark.catalog.join_queries import star
    sides, legs, lines = unfolded_last(star(books).select("entity_sk", "account_key", "cost_centre_key", "project_key", "currency_key", "date_key"))
    assert "yyyyMMdd" not in sides + legs and "yyyyMMdd" in lines
    assert not [c for c in ("cost_centre", "project", "currency_code") if f"({c}#" in sides + legs]
    assert [c for c in ("cost_centre", "project", "currency_code") if f"({c}#" in lines] == ["cost_centre", "project", "currency_code"]


def test_texts_that_postings_share_are_written_for_the_line(spark, books):
    from tallyspark.catalog.projection_queries import staged
    sides, legs, lines = unfolded_last(staged(books).select("posting_date", "document_date", "ingestion_date", "period_year", "debit"))
    assert not [c for c in ("posting_date", "document_date", "period_key") if re.search(rf"cast\(\(?{c}#\d+ .*as string\)|cast\({c}#\d+ as string\)", sides + legs)]
    assert "as string)" in lines
    assert sorted(staged(books).columns) == sorted({*staged(books).columns} - {f"{c}_text" for c in ("posting_date", "period_year")})


def test_lines_are_dealt_out_by_month_before_they_are_unfolded(spark, books):
    from tallyspark.catalog.source_queries import by_month, postings
    sides, legs, lines = unfolded_last(postings(books, by_month).where("period_key < 200007"))
    assert "RebalancePartitions" not in sides + legs and "RebalancePartitions" in lines


def test_versions_of_a_load_come_from_one_scan(spark, books):
    from tallyspark.catalog.source_queries import insert_ignore
    p = insert_ignore(books)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[[^\n]*l_shipdate", p)) == 3  # target, its keys, and the load
