from datetime import date

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyspark.functions import periods as P, sqlfuncs, text as T
from tallyspark.functions.money import ratio


def one(spark, *cols):
    return list(spark.range(1).select(*cols).first())


def test_fiscal_calendar(spark):
    d = F.lit(date(2001, 3, 31))
    assert one(spark, P.fiscal_year_of(d, 4), P.fiscal_period_of(d, 4), P.fiscal_quarter_of(d, 4)) == [2000, 12, 4]
    assert one(spark, P.fiscal_year_of(d), P.fiscal_period_of(d), P.fiscal_quarter_of(d)) == [2001, 3, 1]


def test_prior_periods(spark):
    p = F.lit(202601)
    assert one(spark, P.prior_period_key(p), P.prior_year_key(p), P.period_end_date(p), P.period_label(p)) == [202512, 202501, date(2026, 1, 31), "January 2026"]


@settings(max_examples=15, deadline=None)
@given(st.integers(1990, 2090), st.integers(1, 12), st.integers(-200, 200))
def test_period_add_is_invertible(spark, year, month, k):
    p = year * 100 + month
    assert one(spark, P.period_add(P.period_add(F.lit(p), k), -k)) == [p]


def test_formats_and_blanks(spark):
    null = F.lit(None).cast("double")
    assert one(spark, T.fmt_millions(F.lit(12_300_000.0)), T.fmt_percent(F.lit(4.2)), T.fmt_multiple(F.lit(1.8)), T.fmt_days(F.lit(45.0)),
               T.shown(null, T.fmt_percent(null)), T.is_material(null), T.is_material(F.lit(-5.0)), T.is_material(F.lit(4.99))) == [
        "12.3M HUF", "4.2%", "1.80x", "45 days", None, False, True, False]


def test_ratio_never_divides_by_zero(spark):
    assert one(spark, ratio(F.lit(1), F.lit(0)), ratio(F.lit(1), F.lit(0), otherwise=0), ratio(F.lit(1), F.lit(8), 2)) == [None, 0.0, 0.13]


def test_comma_decimals(spark):
    got = one(spark, *[T.parse_comma_decimal(F.lit(x)) for x in ("1 234,50", "-3,1", "abc", "")])
    assert [None if g is None else str(g) for g in got] == ["1234.50", "-3.10", None, None]


def test_guards(spark):
    assert one(spark, T.is_uuid(F.lit("123e4567-e89b-12d3-a456-426614174000")), T.is_uuid(F.lit("x")), T.is_entity_code(F.lit("NATION_1-A")), T.is_entity_code(F.lit("a b")),
               P.is_valid_period(F.lit(202613)), P.is_valid_period(F.lit(202612))) == [True, False, True, False, False, True]


def test_sql_functions_agree(spark):
    sqlfuncs.register_sql(spark)
    assert list(spark.sql("SELECT tally_prior_period(200101), tally_period_add(200111, 3), tally_fiscal_year(DATE'2001-03-01', 4), tally_valid_code('A-1')").first()) == [200012, 200202, 2000, True]


def test_fingerprint_treats_null_as_empty(spark):
    assert one(spark, T.fingerprint(F.lit("a"), F.lit(None).cast("string")) == T.fingerprint(F.lit("a"), F.lit(""))) == [True]
