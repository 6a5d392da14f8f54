import random
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyspark.operators import access, alerts, anomaly, consolidation, dims, dq, forecast, fx, history as H, intercompany, windows as W
from tallyspark.plans import constants as K
from tallyspark.plans.books import SOURCES, Books
from tallyspark.sources import files, manifest, sinks
from tallyspark.session import fresh_path
from tallyspark.streaming import jobs
from tests.conftest import SF


def test_ledger_always_balances(books):
    d, c, n = books.ledger().agg(F.sum("debit"), F.sum("credit"), F.count("*")).first()
    assert d == c and n > 0
    t = books.trial_balance.agg(F.sum("debit"), F.sum("credit"), F.sum("postings")).first()
    assert tuple(t) == (d, c, n)


def test_asof_equals_brute_force(spark):
    rng = random.Random(3)
    days = [date(2000, 1, 1) + timedelta(days=rng.randrange(60)) for _ in range(15)]
    quotes = {(d, c): Decimal(rng.randrange(300, 500)) for d in days for c in ("EUR", "USD") if rng.random() < 0.7}
    rates = spark.createDataFrame([(d, c, v) for (d, c), v in quotes.items()], "rate_date date, currency_code string, rate_to_huf decimal(16,6)")
    asks = [(date(2000, 1, 1) + timedelta(days=i), c) for i in range(70) for c in ("EUR", "USD")]
    df = spark.createDataFrame(asks, "posting_date date, currency_code string")
    got = {(r.posting_date, r.currency_code): r.rate_to_huf for r in fx.attach_asof(df, fx.densify(rates, "2000-03-31"), rates, "posting_date", "currency_code").collect()}
    for d, c in asks:
        mine = sorted((q, v) for (q, cc), v in quotes.items() if cc == c)
        before = [v for q, v in mine if q <= d]
        assert got[d, c] == (before[-1] if before else mine[-1][1])


def test_fx_range_is_inclusive(spark):
    rates = spark.createDataFrame([(date(2000, 1, 10), "EUR", Decimal(400))], "rate_date date, currency_code string, rate_to_huf decimal(16,6)")
    df = spark.createDataFrame([(date(2000, 1, d), "EUR") for d in (8, 9, 10, 13, 14)] + [(date(2000, 1, 1), "HUF")], "posting_date date, currency_code string")
    assert sorted(r.posting_date.day for r in fx.without_rate(df, rates, 3, 1).collect()) == [8, 14]


def test_scd2_intervals(spark):
    v = lambda rows: spark.createDataFrame(rows, "k string, a string, b int")
    first = H.scd2_first(v([("x", "1", 1), ("y", "1", 1), ("z", None, 1)]), ["a", "b"], "2000-01-01")
    second = H.scd2_apply(first, v([("x", "1", 1), ("y", "2", 1), ("w", "9", 1)]), ["k"], ["a", "b"], "2001-01-01")
    third = H.scd2_apply(second, v([("x", "1", 1), ("y", "1", 1), ("w", "9", 1), ("z", None, 1)]), ["k"], ["a", "b"], "2002-01-01")
    got = {(r.k, r.valid_from.year, r.valid_to.year if r.valid_to else None, r.is_current) for r in third.collect()}
    assert got == {("x", 2000, None, True), ("y", 2000, 2001, False), ("y", 2001, 2002, False), ("y", 2002, None, True), ("z", 2000, 2001, False),
                   ("z", 2002, None, True), ("w", 2001, None, True)}
    again = H.scd2_apply(third, v([("x", "1", 1), ("y", "1", 1), ("w", "9", 1), ("z", None, 1)]), ["k"], ["a", "b"], "2003-01-01")
    assert sorted(map(str, again.collect())) == sorted(map(str, third.collect()))


def test_merge_is_idempotent_and_leaves_other_partitions(spark):
    path = fresh_path(spark, "t")
    rows = lambda r: spark.createDataFrame(r, "id string, v int, p int")
    sinks.write_partitioned(rows([("a", 1, 1), ("b", 1, 1), ("c", 1, 2)]), path, "p", ["id"])
    up = rows([("b", 5, 1), ("d", 5, 1), ("e", 5, 3)])
    want = [("a", 1, 1), ("b", 5, 1), ("c", 1, 2), ("d", 5, 1), ("e", 5, 3)]
    for _ in range(2):
        assert sorted(map(tuple, sinks.merge_partitions(path, up, ["id"], "p", ["id"]).collect())) == want


def test_modified_since_skips_old_files(spark, tmp_path):
    import os
    for name, age in (("old", 3 * 86400), ("new", 0)):
        p = tmp_path / f"{name}.csv"
        p.write_text("a;b\n1;2\n")
        t = datetime(2020, 1, 10).timestamp() - age
        os.utime(p, (t, t))
    assert files.read_since(spark, str(tmp_path), ["a", "b"], "2020-01-09T00:00:00").count() == 1
    assert files.read_since(spark, str(tmp_path), ["a", "b"], "2020-01-01T00:00:00").count() == 2


def test_unknown_source_stops(spark):
    df = spark.createDataFrame([("COBALT",), ("OTHER",)], "source_system string")
    with pytest.raises(Exception, match="no layout for source system OTHER"):
        files.require_known_source(df, K.SOURCE_SYSTEMS).collect()
    with pytest.raises(ValueError):
        files.conform(df, "OTHER")


def test_registry_sides_keep_the_row_count(spark, books):
    n = books.ledger().count()
    assert intercompany.flag_transactions(books.ledger(), books.registry).count() == n
    assert intercompany.flag_effective_dated(books.ledger(), books.registry).count() == n


def test_gate(spark):
    log = spark.createDataFrame([("DQ-001", "PASS"), ("DQ-004", "FAIL")], "rule_id string, check_result string")
    assert dq.gate(log) == 0
    with pytest.raises(dq.GateClosed):
        dq.gate(log.withColumn("rule_id", F.lit("DQ-002")))


def test_duplicates_with_a_hot_key(spark):
    rows = [("e", str(i % 3 if i % 2 else i + 100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "entity_code string, part string")
    got = dq.duplicate_postings(df, ["part"])
    assert got.count() == 1500 and {r.duplicate_count for r in got.select("duplicate_count").distinct().collect()} == {500}


def test_alert_operators(spark):
    ops = spark.createDataFrame([(o, 5.0, 5.0) for o in ("<", ">", "<=", ">=", "=", "!=", "?")], "o string, v double, t double")
    got = {r.o: r.hit for r in ops.select("o", alerts.breached(F.col("v"), F.col("o"), F.col("t")).alias("hit")).collect()}
    assert got == {"<": False, ">": False, "<=": True, ">=": True, "=": True, "!=": False, "?": False}


def test_cooldown_equals_brute_force(spark):
    rng = random.Random(5)
    t0 = datetime(2000, 1, 1)
    make = lambda n: [("r", rng.choice("ab"), t0 + timedelta(minutes=rng.randrange(60 * 24 * 20))) for _ in range(n)]
    cand, log = make(60), [(*x, 30, rng.choice(["OPEN", "CLOSED"])) for x in make(15)]
    c = spark.createDataFrame(cand, "rule_code string, entity_code string, raised_at timestamp")
    l = spark.createDataFrame(log, "rule_code string, entity_code string, raised_at timestamp, cooldown_hours int, status string")
    want = sorted(x for x in cand if not any(s == "OPEN" and e == x[1] and t <= x[2] < t + timedelta(hours=30) for _, e, t, _, s in log))
    assert sorted(map(tuple, alerts.after_cooldown(c, l).collect())) == want


def test_off_hours_boundary(spark):
    rows = [(1, 200101, h) for h in [6] * 3 + [23] * 2 + [7, 22] * 5] + [(2, 200101, 3)] * 6
    df = spark.createDataFrame(rows, "entity_key int, period_key int, posting_hour int")
    assert [tuple(r) for r in anomaly.off_hours(df).collect()] == [(2, 200101, 6)]


def history(spark, current):
    rng = random.Random(42)
    rows = []
    for i in range(21):
        p = 202401 + i if i < 12 else 202501 + i - 12
        rows.append((p, 1, *[100.0 + rng.gauss(0, 1) for _ in anomaly.KPI_COLUMNS]))
    rows[-1] = (rows[-1][0], 1, *[current] * len(anomaly.KPI_COLUMNS))
    return spark.createDataFrame(rows, "period_key int, entity_key int, " + ", ".join(f"{c} double" for c in anomaly.KPI_COLUMNS)), rows[-1][0]


def test_zscore_quiet_and_loud(spark):
    quiet, p = history(spark, 100.0)
    assert anomaly.zscores(quiet, p).count() == 0
    loud, p = history(spark, 110.0)
    got = anomaly.zscores(loud, p).collect()
    assert len(got) == len(anomaly.KPI_COLUMNS) and {r.severity for r in got} == {"CRITICAL"}
    assert anomaly.zscores(loud.where("period_key > 202507"), p).count() == 0  # too little history


def test_isolation_forest_finds_the_outlier(spark):
    loud, p = history(spark, 140.0)
    r = anomaly.isolation_forest(loud, p, trees=50).collect()
    assert len(r) == 1 and r[0].is_outlier
    again = anomaly.isolation_forest(loud, p, trees=50).first()
    assert again.anomaly_score == r[0].anomaly_score


def test_forecast_of_a_straight_line(spark):
    rows = [(1, "k", 200001 + i if i < 12 else 200101 + i - 12, Decimal(100 + 10 * i), 24000 + i) for i in range(24)]
    h = spark.createDataFrame(rows, "entity_key int, kpi string, period_key int, value decimal(38,2), mi int")
    got = forecast.seasonal(h).orderBy("period_key").collect()
    assert [r.period_key for r in got] == [200201 + i for i in range(12)]
    assert all(abs(r.p50 - (340 + 10 * i)) < 0.02 and abs(r.p90 - r.p10) < 0.02 for i, r in enumerate(got))
    assert [r.p50 for r in forecast.drift(h.where("mi < 24007")).orderBy("period_key").collect()] == [170.0 + 10 * i for i in range(12)]
    assert forecast.forecast(h.where("mi < 24005")).count() == 0


def test_surrogate_keys_are_dense(spark):
    df = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("code"))
    got = sorted(r.k for r in dims.surrogate_key(df, ["code"], "k").collect())
    assert got == list(range(1, 5001))


def test_issued_keys_stay(spark):
    member = lambda ids, v: spark.createDataFrame([(f"c{i}", v) for i in ids], "code string, v string")
    first = {r.code: r.k for r in dims.issue_keys(None, member(range(50), "a"), ["code"], "k").collect()}
    issued = dims.issue_keys(None, member(range(50), "a"), ["code"], "k")
    second = {r.code: (r.k, r.v) for r in dims.issue_keys(issued, member(range(5, 60), "b"), ["code"], "k").collect()}
    assert all(second[c][0] == k for c, k in first.items()) and sorted(k for k, _ in second.values()) == list(range(1, 61))
    assert second["c3"][1] == "a" and second["c7"][1] == "b" and sorted(second[f"c{i}"][0] for i in range(50, 60)) == list(range(51, 61))


def test_movable_holidays(spark):
    known = [(2024, date(2024, 3, 31)), (2025, date(2025, 4, 20)), (2026, date(2026, 4, 5)), (2027, date(2027, 3, 28)), (1954, date(1954, 4, 18)), (1981, date(1981, 4, 19)),
             (2049, date(2049, 4, 18)), (1818, date(1818, 3, 22)), (2285, date(2285, 3, 22))]
    got = spark.createDataFrame([(y,) for y, _ in known], "y int").select("y", dims.easter_sunday(F.col("y")).alias("e")).collect()
    assert [(r.y, r.e) for r in got] == known
    days = spark.createDataFrame([(date(2024, 3, 29),), (date(2024, 4, 1),), (date(2024, 5, 20),), (date(2024, 5, 21),)], "d date").select(dims.holiday_flag(F.col("d")).alias("h")).collect()
    assert [r.h for r in days] == [True, True, True, False]


def test_first_per_key(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    assert sorted(map(tuple, W.first_per_key(df, ["k"], ["o"]).collect())) == [("a", 1, "y"), ("b", 5, "z")]


def test_late_ids_stay_whole(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.concat(F.lit("t"), "id").alias("transaction_id"))
    chunks = H.late_id_chunks(df, ["g"], F.lit(True), size=100).collect()
    ids = [i for r in chunks for i in r.late_ids]
    assert len(ids) == len(set(ids)) == 5000 and max(len(r.late_ids) for r in chunks) < 250


def test_publish_twice_changes_nothing(spark):
    q = spark.createDataFrame([(1, 1, 200101, "cfo", "t", "APPROVED"), (2, 1, 200101, "cfo", "t", "PENDING")],
                              "queue_id long, entity_key int, period_key int, role string, content string, status string")
    empty = spark.createDataFrame([], "source_queue_id long, entity_key int, period_key int, role string, content string")
    out, state = H.publish(q, empty)
    out2, state2 = H.publish(state, out)
    assert out.count() == out2.count() == 1
    assert {r.queue_id: r.status for r in state2.collect()} == {1: "PUBLISHED", 2: "PENDING"}


def test_entity_isolation(spark, books):
    df = spark.createDataFrame([(i,) for i in range(25)], "entity_key int")
    m = spark.createDataFrame([(1, 3, True, "CEO"), (1, 4, False, "CEO")], "user_id long, entity_key int, is_active boolean, role string")
    assert [r.entity_key for r in access.entity_scope(df, m, 1).collect()] == [3]
    assert access.entity_scope(df, m, 2).count() == 0
    assert sorted(r.entity_key for r in access.group_scope(df, m, books.entities, 1).collect()) == [3, 8, 13, 18, 23]
    assert access.auditor_scope(df, [1, 2], "2001-12-30", K.AS_OF).count() == 0
    assert access.auditor_scope(df, [1, 2], K.AS_OF, K.AS_OF).count() == 2


def test_gate_halts_the_close(spark, books):
    from tallyspark.plans.close import run_close
    broken = books.ledger().where("NOT (side = 'C' AND leg = 'S4')")
    assert run_close(spark, books.dir, 200106, raw=broken).status == "HALTED"


def test_closes_take_new_and_changed_batches_only(spark, books, tmp_path):
    """Two months, then late rows of the first, then nothing new."""
    from tallyspark.plans.close import run_close
    ledger = books.ledger().where("period_key <= 199508").cache()
    first, second = [r[0] for r in ledger.select("period_key").distinct().sort("period_key").tail(2)]
    early = ledger.where(f"NOT (period_key = {first} AND partkey % 10 = 0)")
    target = str(tmp_path / "close")
    close = lambda period, rows: run_close(spark, books.dir, period, target, rows)
    fact = lambda: spark.read.parquet(f"{target}/fact")
    mapped = lambda rows, until: rows.where((F.col("leg") != "S3U") & (F.col("period_key") <= until))
    total = lambda rows: rows.groupBy("period_key").agg(F.count("*").alias("n"), F.sum("debit").alias("d")).sort("period_key").collect()

    one = close(first, early)
    assert one.status == "COMPLETED" and total(fact()) == total(mapped(early, first))
    two = close(second, early)
    assert two.changed_batches == early.where(F.col("period_key") == second).select("batch_id").distinct().count()
    assert total(fact()) == total(mapped(early, second))
    assert spark.read.parquet(f"{target}/quarantine").where("leg <> 'S3U'").isEmpty()
    pl = lambda: spark.read.parquet(f"{target}/pl_monthly").where(f"period_key = {first} AND consolidation_scope = 'entity'").agg(F.sum("revenue")).first()[0]
    before = pl()
    three = close(second, ledger)
    late = ledger.where(f"period_key = {first} AND partkey % 10 = 0")
    assert 0 < three.changed_batches == late.select("batch_id").distinct().count()
    assert total(fact()) == total(mapped(ledger, second)) and pl() != before
    stamp = (tmp_path / "close" / "fact").stat().st_mtime_ns
    assert close(second, ledger).status == "UNCHANGED" and (tmp_path / "close" / "fact").stat().st_mtime_ns == stamp
    ledger.unpersist()


def test_gold_tables_follow_their_sources(spark, tmp_path):
    import shutil
    for f in SOURCES:
        shutil.copyfile(f"{SF}/{f}.parquet", tmp_path / f"{f}.parquet")
    postings = lambda: Books(spark, str(tmp_path)).trial_balance.agg(F.sum("postings")).first()[0]
    before = postings()
    pq.write_table(pq.read_table(f"{SF}/lineitem.parquet").slice(0, 3000), tmp_path / "lineitem.parquet")
    assert 0 < postings() < before


def test_conversion_of_large_amounts_is_exact(spark):
    amounts = ["12345678901.23", "1234567890123.45", "9999999999999999.99", "-9999999999999999.99", "0.01", "-0.01", "0.00", None]
    rates = ["1.000000", "380.125000", "0.000001", "999.999999", "400.000000"]
    rows = [(None if a is None else Decimal(a), Decimal(r)) for a in amounts for r in rates]
    df = spark.createDataFrame(rows, "a decimal(18,2), r decimal(16,6)")
    cent = Decimal("0.01")
    fits = lambda x: x is None or abs(x) < Decimal(10) ** 16
    for a, r, times, over in df.where("abs(a) * r < 1e16").select("a", "r", fx.times("a", "r").alias("t"), F.lit(None)).collect() + df.where("abs(a) / r < 1e16 OR a IS NULL").select(
            "a", "r", F.lit(None), fx.over("a", "r").alias("o")).collect():
        with localcontext() as c:
            c.prec = 60
            if times is not None:
                assert times == (a * r).quantize(cent, ROUND_HALF_UP)
            if over is not None:
                assert over == (a / r).quantize(cent, ROUND_HALF_UP)
            assert fits(times) and fits(over)
    one = df.where("r = 1").select("a", fx.times("a", "r").alias("t"), fx.over("a", "r").alias("o"), fx.crossed("a", F.col("r"), F.col("r")).alias("c")).collect()
    assert len(one) == len(amounts) and all(x.a == x.t == x.o == x.c for x in one)


def landed(spark, path, frames):
    """Files that arrive in the given order, one per batch."""
    import os
    import time
    for i, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(str(path))
        for f in path.glob("part-*"):
            if not (path / f".seen-{f.name}").exists():
                (path / f".seen-{f.name}").touch()
                os.utime(f, (time.time() - 1000 + i, time.time() - 1000 + i))
    return jobs.read_landed(spark, str(path), frames[0].schema, 1)


def test_stream_dedupe_keeps_every_first_row(spark, tmp_path):
    """Over 166 days, latest files first: nothing is too late."""
    rows = [(i % 2000, datetime(2024, 1, 1, 12) + timedelta(hours=i % 2000 * 2, minutes=i // 2000)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, t timestamp")
    files = [df.where(F.col("k").between(400 * i, 400 * i + 500)) for i in reversed(range(5))]
    out = jobs.dedupe_table(landed(spark, tmp_path / "in", files), "first", "t", ["k"]).collect()
    assert len(out) == 2000 == len({r.k for r in out}) and all(r.t.minute == 0 for r in out)


def test_stream_cooldown_follows_event_time(spark, tmp_path):
    at = lambda *x: datetime(2024, 1, *x)
    early = [("r", "e", at(1, 10, 30)), ("r", "e", at(1, 10, 40)), (None, "e", at(1, 0, 0)), ("r", "f", at(2, 0, 0))]
    late = [("r", "e", at(3, 10, 10)), ("r", "e", at(3, 10, 40)), ("r", "e", None), ("r", "f", at(1, 0, 0)), ("r", "f", at(3, 0, 0))]
    schema = "rule_code string, entity_code string, raised_at timestamp"
    stream = landed(spark, tmp_path / "in", [spark.createDataFrame(x, schema) for x in (late, early)])
    got = sorted(map(tuple, jobs.cooldown_table(stream, "fired", 48).collect()), key=str)
    assert got == sorted([("r", "e", at(1, 10, 30)), ("r", "e", at(3, 10, 40)), (None, "e", at(1, 0, 0)), ("r", "f", at(1, 0, 0)), ("r", "f", at(3, 0, 0))], key=str)


def test_cooldown_in_small_batches(spark):
    import random
    rng = random.Random(4)
    rows = [("r", rng.choice("ab"), datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 200_000))) for _ in range(3000)]
    want = []
    for e in "ab":
        last = None
        for t in sorted(t for _, x, t in rows if x == e):
            if last is None or t >= last + timedelta(hours=48):
                want.append(("r", e, t))
                last = t
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = jobs.fired(spark.createDataFrame(rows, "rule_code string, entity_code string, raised_at timestamp"), 48).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got)) == sorted(want)


def test_sessions_join_across_batches(spark, tmp_path):
    at = lambda m: datetime(2024, 1, 1) + timedelta(minutes=m)
    schema = "u int, t timestamp"
    files = [[(1, at(0)), (1, at(50)), (2, at(5))], [(1, at(25)), (1, at(200))], [(1, at(75)), (2, at(35))]]
    stream = landed(spark, tmp_path / "in", [spark.createDataFrame(f, schema) for f in files])
    got = sorted((r.u, r.n, (r.session_start - at(0)).seconds // 60, (r.session_end - at(0)).seconds // 60) for r in jobs.sessions(stream, "s", "t", ["u"], "30 minutes").collect())
    assert got == [(1, 1, 200, 230), (1, 4, 0, 105), (2, 1, 5, 35), (2, 1, 35, 65)]


def test_merge_leaves_other_months_alone(spark, tmp_path):
    path = str(tmp_path / "fact")
    rows = spark.createDataFrame([(i, 200001 + i % 3, i) for i in range(30)], "id int, period_key int, v int")
    sinks.write_partitioned(rows, path, "period_key", ["id"])
    stamps = lambda m: sorted((f.name, f.stat().st_mtime_ns) for f in (tmp_path / "fact" / f"period_key={m}").glob("*.parquet"))
    before = {m: stamps(m) for m in (200001, 200002, 200003)}
    update = spark.createDataFrame([(1, 200002, 100), (99, 200002, 7)], "id int, period_key int, v int")
    out = {r.id: r.v for r in sinks.merge_partitions(path, update, ["id"], "period_key", ["id"]).collect()}
    assert out == {i: i for i in range(30)} | {1: 100, 99: 7}
    assert stamps(200001) == before[200001] and stamps(200003) == before[200003] and stamps(200002) != before[200002]


def test_several_relations_of_a_pair_do_not_double(spark):
    """One amount, one elimination, although the pair has relations of three types with accounts of their own."""
    registry = spark.createDataFrame(
        [(1, 1, 2, "9711", "511", "GOODS_SALE", "REVENUE_EXPENSE", True, None, None), (2, 1, 2, "314", "455", "LOAN", "RECEIVABLE_PAYABLE", True, None, None),
         (3, 1, 2, "962", "513", "SERVICE", "REVENUE_EXPENSE", True, None, None), (4, 1, 2, "06", "411", "DIVIDEND", "INVESTMENT_EQUITY", True, None, None),
         (5, 2, 1, "9711", "511", "GOODS_SALE", "REVENUE_EXPENSE", False, None, None), (6, 1, 2, "9711", "511", "SERVICE", "REVENUE_EXPENSE", True, None, None)],
        "pair_id int, seller_key int, buyer_key int, seller_account string, buyer_account string, transaction_type string, elimination_type string, is_active boolean, valid_from date, valid_to date")
    net = lambda x: Decimal(x)
    ledger = spark.createDataFrame(
        [(200001, 1, "9711", 2, net("-100.00")), (200001, 2, "511", 1, net("100.00")), (200001, 1, "314", 2, net("40.00")), (200001, 2, "455", 1, net("-40.00")),
         (200001, 1, "962", 2, net("-7.00")), (200001, 2, "9711", 1, net("-5.00")), (200001, 1, "9711", 3, net("-9.00")), (200001, 1, "06", 2, net("3.00"))],
        "period_key int, entity_key int, account_code string, counterparty_key int, net decimal(18,2)")
    got = {(r.pair_id, r.pl_line_item): r.eliminated_amount for r in consolidation.ic_eliminations(ledger, registry).collect()}
    assert got == {(1, "Revenue"): 100, (1, "COGS"): 100, (2, "Receivable"): 40, (2, "Payable"): 40, (3, "Revenue"): 7, (4, "Investment"): 3}
    assert {(r.pair_id, r.sides_present, r.status) for r in consolidation.ic_pair_completeness(ledger, registry).collect()} == {
        (1, 2, "OK"), (2, 2, "OK"), (3, 1, "OUT_OF_BALANCE"), (4, 1, "OUT_OF_BALANCE"), (6, 0, "NO_ACTIVITY")}
    dated = registry.withColumns({"valid_from": F.to_date(F.lit("1999-01-01"))})
    assert intercompany.flag_effective_dated(ledger.withColumn("posting_date", F.to_date(F.lit("2000-01-05"))), dated).count() == 8


def cooled(rows, hours):
    """Alerts by walking through each key's times."""
    out, last = [], {}
    for rule, entity, t in sorted((r for r in rows if r[2] is not None), key=lambda r: (str(r[:2]), r[2])):
        at = last.get((rule, entity))
        if at is None or t >= at + timedelta(hours=hours):
            out.append((rule, entity, t))
            last[rule, entity] = t
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", [400, 3])
def test_stream_cooldown_in_any_order(spark, tmp_path, keep):
    """Files in random order, copies of candidates, null keys; with few days of state most files are late, and nothing else changes."""
    rng = random.Random(keep)
    rows = [(rng.choice(["r", "s", None]), rng.choice("ab"), datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 60_000))) for _ in range(600)]
    rows += rows[:50] + [("r", "a", None)]
    rng.shuffle(rows)
    schema = "rule_code string, entity_code string, raised_at timestamp"
    parts = [spark.createDataFrame(rows[i::6], schema) for i in range(6)]
    got = jobs.cooldown_table(landed(spark, tmp_path / "in", parts), "cooled", 30, keep).collect()
    assert sorted(map(tuple, got), key=str) == cooled(rows, 30)


def test_cooldown_changes_touch_their_own_keys_and_stop_where_the_chain_meets(spark, tmp_path):
    at = lambda d, h=0: datetime(2024, 1, 1) + timedelta(days=d, hours=h)
    schema = "rule_code string, entity_code string, raised_at timestamp"
    first = [("r", "a", at(d)) for d in range(0, 40, 4)] + [("r", "b", at(3))]
    second = [("r", "a", at(5))]  # between alerts: it fires, and those after it that it silences are withdrawn until the chain is the old one
    stream = landed(spark, tmp_path / "in", [spark.createDataFrame(x, schema) for x in (first, second)])
    _, changes = jobs.cooldown_changes(stream, "changes", 24 * 2)
    rows = [(r.entity_code, (r.raised_at - 1704067200000000) // jobs.DAY, r.change) for r in changes.collect()]
    assert sorted(x for x in rows if x[0] == "b") == [("b", 3, 1)]
    assert sorted(r[1:] for r in rows if r[0] == "a") == sorted([(d, 1) for d in range(0, 40, 4)])
    _, changes = jobs.cooldown_changes(landed(spark, tmp_path / "in2", [spark.createDataFrame(x, schema) for x in (first, [("r", "a", at(6))])]), "changes", 24 * 2)
    rows = sorted(((r.raised_at - 1704067200000000) // jobs.DAY, r.change) for r in changes.collect() if r.entity_code == "a")
    assert rows == sorted([(d, 1) for d in range(0, 40, 4)] + [(6, 1)])
    _, changes = jobs.cooldown_changes(landed(spark, tmp_path / "in3", [spark.createDataFrame(x, schema) for x in (first, [("r", "a", at(7))])]), "changes", 24 * 2)
    rows = sorted(((r.raised_at - 1704067200000000) // jobs.DAY, r.change) for r in changes.collect() if r.entity_code == "a")
    assert rows == sorted([(d, 1) for d in range(0, 40, 4)] + [(7, 1), (8, -1)])


def test_stream_dedupe_takes_the_earliest(spark, tmp_path):
    """The later time comes in the first file, and in the second one a time between."""
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    schema = "k int, t timestamp, v int"
    files = [[(1, at(10), 1), (2, at(9), 1)], [(1, at(8), 2), (3, at(1), 2)], [(1, at(9), 3), (2, at(9, 30), 3)]]
    out = jobs.dedupe_table(landed(spark, tmp_path / "in", [spark.createDataFrame(f, schema) for f in files]), "first", "t", ["k"])
    assert sorted((r.k, r.t, r.v) for r in out.collect()) == [(1, at(8), 2), (2, at(9), 1), (3, at(1), 2)]


def test_merge_moves_keys_and_takes_one_version(spark):
    path = fresh_path(spark, "t")
    rows = lambda r: spark.createDataFrame(r, "id string, v int, p int")
    sinks.write_partitioned(rows([("a", 1, 1), ("b", 1, 1), ("z", 1, 3)]), path, "p", ["id"])
    load = rows([("a", 2, 2), ("c", 1, 2), ("c", 7, 2), ("c", 3, 1), ("z", 0, 2)])
    for _ in range(2):
        assert sorted(map(tuple, sinks.merge_partitions(path, load, ["id"], "p", ["id"], ["v"]).collect())) == [("a", 2, 2), ("b", 1, 1), ("c", 7, 2), ("z", 1, 3)]
    # without versions the load wins, and a partition that is left empty goes
    assert sorted(map(tuple, sinks.merge_partitions(path, rows([("z", 0, 2)]), ["id"], "p", ["id"]).collect())) == [("a", 2, 2), ("b", 1, 1), ("c", 7, 2), ("z", 0, 2)]
    assert not sinks.exists(spark, f"{path}/p=3")
    target = rows([("a", 1, 1)])
    assert sorted(map(tuple, sinks.inserted(target, rows([("a", 9, 1), ("n", 1, 1), ("n", 2, 1)]), ["id"], ["v"]).collect())) == [("a", 1, 1), ("n", 2, 1)]


def test_hierarchy_of_a_hundred_levels(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None) for i in range(101)] + [(500, None), (501, 77)], "entity_key int, parent_key int")
    got = {(r.ancestor_key, r.descendant_key): r.depth for r in dims.entity_hierarchy(chain).collect()}
    want = {(a, d): d - a for d in range(101) for a in range(d + 1)} | {(500, 500): 0, (501, 501): 0} | {(a, 501): 78 - a for a in range(78)}
    assert got == want
    ring = spark.createDataFrame([(1, 3), (2, 1), (3, 2), (4, 3), (5, None)], "entity_key int, parent_key int")
    with pytest.raises(ValueError, match="cycle through 1, 2, 3"):
        dims.entity_hierarchy(ring)


def test_valid_at_with_many_versions(spark):
    """One key has 100,000 versions, with gaps; others have none or one that is still open."""
    rng = random.Random(2)
    begin = date(1800, 1, 1)
    days = sorted(rng.sample(range(120_000), 100_000))
    versions = [("k", begin + timedelta(d), begin + timedelta(d + 1 if i % 7 == 0 else (days[i + 1] if i + 1 < len(days) else d + 5)), i) for i, d in enumerate(days)]
    versions.append(("open", begin + timedelta(10), None, -1))
    facts = [(rng.choice(["k", "open", "none"]), begin + timedelta(rng.randint(0, 121_000)), i) for i in range(3000)] + [("k", None, 9999)]
    got = H.valid_at(spark.createDataFrame(facts, "key string, day date, id int"), spark.createDataFrame(versions, "key string, valid_from date, valid_to date, v int"), ["key"], "day", ["v"])
    at = {}
    for key, start, end, v in versions[:-1]:
        for d in range((end - start).days):
            at.setdefault(start + timedelta(d), v)
    want = sorted((k, d, i, at[d] if k == "k" else -1) for k, d, i in facts if d and ((k == "k" and d in at) or (k == "open" and d >= begin + timedelta(10))))
    assert sorted(map(tuple, got.collect())) == want


def test_alerts_fire_once_and_move_forward(spark):
    entities = spark.createDataFrame([(1, "E1"), (2, "E2")], "entity_key int, entity_code string")
    rules = spark.createDataFrame([("R", "cash", "ALL", "<", 10.0, "ABSOLUTE", "HIGH", 24)], K.RULE_COLUMNS).withColumn("cooldown_hours", F.col("cooldown_hours").cast("int"))
    kpis = spark.createDataFrame([(1, 200001, "cash", 5.0), (1, 200002, "cash", 4.0), (2, 200002, "cash", 50.0)], "entity_key int, period_key int, kpi_name string, value double").withColumns(
        {"budget_value": F.lit(None).cast("double"), "py_value": F.lit(None).cast("double")})
    at = lambda h: F.lit(datetime(2000, 3, 1, 0) + timedelta(hours=h))
    keep = lambda df: spark.createDataFrame(df.collect(), alerts.LOG)
    log = keep(alerts.evaluate_into(None, kpis, rules, entities, at(0)))
    assert [(r.entity_code, r.period_key, r.status) for r in log.collect()] == [("E1", 200002, "OPEN")]
    for hour, n in ((0, 1), (23, 1), (24, 2)):
        assert alerts.evaluate_into(log, kpis, rules, entities, at(hour)).count() == n
    ident = log.first().alert_id
    change = lambda *c: spark.createDataFrame([(ident, s, datetime(2000, 3, 1, h)) for s, h in c], "alert_id string, status string, at timestamp")
    log = keep(alerts.advance(log, change(("ACKNOWLEDGED", 2), ("ACKNOWLEDGED", 1), ("OPEN", 0))))
    assert (log.first().status, log.first().acknowledged_at.hour) == ("ACKNOWLEDGED", 1)
    assert alerts.evaluate_into(log, kpis, rules, entities, at(5)).count() == 1
    log = keep(alerts.advance(alerts.advance(log, change(("CLOSED", 4))), change(("ACKNOWLEDGED", 6))))
    assert (log.first().status, log.first().closed_at.hour) == ("CLOSED", 4)
    assert alerts.evaluate_into(log, kpis, rules, entities, at(0)).count() == 1 and alerts.evaluate_into(log, kpis, rules, entities, at(5)).count() == 2


def test_registry_stays_without_an_optional_library():
    import subprocess
    import sys
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); assert len(q) > 300 and 'pl_monthly' in q and set(e.oracle_sql()) <= set(q)"
    import os
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0


def test_the_whole_queue_has_the_rules_rows_and_the_forests(spark):
    """The forest's rows are those of a plain forest with the same seeds."""
    import numpy as np
    from tallyspark import catalog
    from tallyspark.catalog import detection_queries as D
    whole = [tuple(r) for r in catalog.queries()["anomaly_queue"](spark, SF).collect()]
    rules = [tuple(r) for r in catalog.queries()["anomaly_queue_rules"](spark, SF).collect()]
    found = [r for r in whole if r[3] == "ISOLATION_FOREST"]
    assert sorted(map(str, rules)) == sorted(map(str, [r for r in whole if r[3] != "ISOLATION_FOREST"])) and found
    want = {}
    history = D.history(Books(spark, SF)).toPandas().sort_values("period_key")
    for key, months in history.groupby("entity_key"):
        if len(months) >= 3 and (months.period_key == D.CURRENT).any():
            x = months[anomaly.KPI_COLUMNS].astype(float).fillna(0.0).to_numpy()
            s = anomaly._path_lengths(x, np.random.default_rng(anomaly.SEED + int(key)), anomaly.TREES, anomaly.ROWS_PER_TREE)
            now = s[(months.period_key == D.CURRENT).to_numpy()][0]
            if now > np.quantile(s, 1 - anomaly.CONTAMINATION):
                want[key] = now
    assert {r[0]: pytest.approx(r[10]) for r in found} == want


def test_a_thousand_questions_equal_brute_force(spark, monkeypatch):
    """Over several blocks of questions and partitions of documents, with ties and documents without a direction."""
    import numpy as np
    from tallyspark.operators import retrieval
    monkeypatch.setattr(retrieval, "QUESTIONS_AT_ONCE", 300)
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(400, 8)), rng.normal(size=(1000, 8))
    x[7] = x[9]
    texts = [["alpha", "beta", "Alpha beta", None][i % 4] for i in range(400)]
    texts[7] = texts[9]
    docs = [(i, t, v.tolist()) for i, (t, v) in enumerate(zip(texts, x))] + [(500, "alpha", None), (501, "alpha", [0.0] * 8), (502, "beta", [1.0])]
    words = [["alpha"], ["alpha", "beta"], ["x"]]
    got = retrieval.top_matches_many(spark.createDataFrame(docs, "doc_id bigint, text string, embedding array<double>").repartition(5),
                                     spark.createDataFrame([(i, v.tolist(), words[i % 3]) for i, v in enumerate(q)], "question_id bigint, vector array<double>, words array<string>"), 5)
    found = {}
    for r in got.collect():
        found.setdefault(r.question_id, {})[r.place] = (r.doc_id, r.score)
    cosines = (x / np.sqrt((x ** 2).sum(1, keepdims=True))) @ (q / np.sqrt((q ** 2).sum(1, keepdims=True))).T
    for j in range(1000):
        share = [sum(w in (t or "").lower() for w in words[j % 3]) / len(words[j % 3]) for t in texts]
        scores = retrieval._half_up(0.7 * cosines[:, j] + 0.3 * np.array(share))
        order = sorted(range(400), key=lambda i: (-scores[i], i))[:5]
        assert [found[j][p + 1] for p in range(5)] == [(i, pytest.approx(scores[i])) for i in order]


def window_files(spark, tmp_path, days, reverse):
    """One file per batch: each day's rows, a few of them from ten and twenty days before; a key that is null, one with most rows."""
    schema = "u string, t timestamp"
    at = lambda d, m: datetime(2024, 1, 1) + timedelta(days=d, minutes=m)
    rows = [[("a", at(d, 13 * i)) for i in range(40)] + [(None, at(d, 700)), ("b", at(d - 10, d)), ("b", at(d - 20, 5))] for d in range(days)]
    files = rows[::-1] if reverse else rows
    return landed(spark, tmp_path / "in", [spark.createDataFrame(f, schema) for f in files]), [r for f in rows for r in f]


@pytest.mark.parametrize("reverse", [False, True])
def test_windows_close_and_take_corrections(spark, tmp_path, monkeypatch, reverse):
    stream, rows = window_files(spark, tmp_path, 12, reverse)
    out = {}
    put = jobs.fresh_path
    monkeypatch.setattr(jobs, "fresh_path", lambda s, label: out.setdefault(label, put(s, label)))
    got = sorted(((r.window_start, r.u, r.n) for r in jobs.tumbling_counts(stream, "w", "t", ["u"], "1 day", open_days=2).collect()), key=str)
    want = {}
    for u, t in rows:
        day = t.replace(hour=0, minute=0)
        want[day, u] = want.get((day, u), 0) + 1
    assert got == sorted(((d, u, n) for (d, u), n in want.items()), key=str)
    parts = spark.read.parquet(out["w"].replace("file:", "")).groupBy("__epoch", "__part").count().collect()
    assert {r["__epoch"] for r in parts if r["__part"] == "open"} == {10, 11}  # the open windows of earlier batches are gone
    held = max(r["count"] for r in parts if r["__part"] == "open")
    assert any(r["__part"] == "late" for r in parts) and held < len(want) / 3
    assert reverse or any(r["__part"] == "closed" for r in parts)


@pytest.mark.parametrize("reverse", [False, True])
def test_sessions_close_and_touch_late_rows(spark, tmp_path, reverse):
    stream, rows = window_files(spark, tmp_path, 6, reverse)
    got = sorted(((r.u, r.session_start, r.session_end, r.n) for r in jobs.sessions(stream, "s", "t", ["u"], "20 minutes", open_days=0.001).collect()), key=str)
    gap, want = timedelta(minutes=20), []
    for u in ("a", "b", None):
        for t in sorted(t for v, t in rows if v == u):
            if want and want[-1][0] == u and t < want[-1][2]:
                want[-1] = (u, want[-1][1], t + gap, want[-1][3] + 1)
            else:
                want.append((u, t, t + gap, 1))
    assert got == sorted(want, key=str)


def test_windows_of_an_empty_stream(spark, tmp_path):
    stream = landed(spark, tmp_path / "in", [spark.createDataFrame([], "u string, t timestamp")])
    assert jobs.tumbling_counts(stream, "none", "t", ["u"], "1 day").count() == 0


def test_a_repeated_batch_of_windows_changes_nothing(spark, tmp_path, monkeypatch):
    stream, _ = window_files(spark, tmp_path, 4, False)
    once = sorted(map(str, jobs.tumbling_counts(stream, "once", "t", ["u"], "1 day", open_days=1).collect()))
    again = []
    writer = type(stream.writeStream)
    each = writer.foreachBatch
    monkeypatch.setattr(writer, "foreachBatch", lambda self, f: each(self, lambda batch, epoch: (f(batch, epoch), again.append(epoch), f(batch, epoch))[0]))
    assert sorted(map(str, jobs.tumbling_counts(stream, "twice", "t", ["u"], "1 day", open_days=1).collect())) == once and len(again) == 4


def test_manifest_reads_files_in_pieces(spark, tmp_path):
    """A file beyond what one binary value holds (sparse, so it takes no disk), an empty one, an odd name; pieces smaller than files."""
    import hashlib
    large, odd, size = tmp_path / "part-large.csv", tmp_path / "part-a b%41+=ü.txt", (1 << 31) + 17
    with open(large, "wb") as f:
        f.truncate(size)
    odd.write_bytes(b"some text")
    (tmp_path / "part-none.xml").touch()
    want = hashlib.sha256()
    for _ in range(1 << 11):
        want.update(bytes(1 << 20))
    want.update(bytes(17))
    got = {r.file_format: (r.file_bytes, r.content_hash, r.status) for r in manifest.manifest(manifest.scan_files(spark, str(tmp_path)), piece=1 << 22).collect()}
    assert got == {"CSV": (size, want.hexdigest(), "RECEIVED"), "TXT": (9, hashlib.sha256(b"some text").hexdigest(), "RECEIVED"), "XML": (0, hashlib.sha256().hexdigest(), "EMPTY")}
    small = manifest.with_digest(manifest.scan_files(spark, str(tmp_path), "*.txt"), piece=2).first()
    assert small.content_hash == got["TXT"][1]
    checked = manifest.landing_check(manifest.scan_files(spark, str(tmp_path), "*.xml")).first()
    assert (checked.files, checked.bytes, checked.too_small, checked.status) == (1, 0, 1, "TOO_SMALL")


def test_backlog_is_taken_in_few_batches(spark, tmp_path):
    """However many files lie there, a stream takes them in BATCHES batches at most; few files are taken as asked."""
    path = str(tmp_path / "landed")
    spark.range(60).repartition(30).write.parquet(path)
    files = len([n for n in sinks.names(spark, path) if n.startswith("part-")])
    assert files == 30 and jobs.files_a_batch(spark, path, 1) == 4 and jobs.files_a_batch(spark, path, 50) == 50
    taken = []
    stream = jobs.read_backlog(spark, path, spark.read.parquet(path).schema, 2)
    stream.writeStream.foreachBatch(lambda batch, epoch: taken.append(batch.count())).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert sum(taken) == 60 and 2 <= len(taken) <= jobs.BATCHES
    assert sinks.names(spark, str(tmp_path / "nowhere")) == []


def test_cooldown_state_is_not_written_for_days_that_go(spark):
    """A batch over many days leaves only the kept ones in the state, and writes no others."""
    class Value:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held
        def update(self, x): self.held = x

    class Days(dict):
        written = 0
        exists = lambda self: bool(self)
        keys = lambda self: iter(list(dict.keys(self)))
        containsKey = dict.__contains__
        getValue = dict.__getitem__
        removeKey = dict.__delitem__
        def updateValue(self, k, v):
            self.written += 1
            self[k] = v

    import pandas as pd
    c = jobs.Cooldown(48, 10)
    c.days, c.before = Days(), Value()
    at = [d * jobs.DAY for d in range(100)]
    out = pd.concat(c.handleInputRows(("r", "e"), iter([pd.DataFrame({"at": at})]), None))
    assert list(out[out.change == jobs.FIRED].raised_at) == at[::2] and c.days.written == 10 and len(c.days) == 10
    assert c.before.held == (90, 88 * jobs.DAY)


def test_hash_screened_rules_equal_plain_ones(spark):
    """Repeated keys are found whatever repeats, nulls and empty texts included, and only hashes are shuffled for rows that are alone."""
    rng = random.Random(5)
    pick = lambda values: rng.choice([None, *values])
    rows = [(pick(["A", "B", ""]), pick(["s"]), f"{rng.randrange(40)}", pick(["S1", "S2"]), rng.choice("DC"), f"b{i}", date(2000, 1, 1 + i % 20)) for i in range(300)]
    df = spark.createDataFrame(rows, "entity_code string, source_system string, source_id string, leg string, side string, batch_id string, posting_date date")
    want = {}
    for r in rows:
        want.setdefault(r[:5], []).append(r)
    got = {tuple(r)[:5]: tuple(r)[5:] for r in dq.duplicate_sources(df).collect()}
    assert got == {k: (len(v), min(r[5] for r in v), max(r[5] for r in v), min(r[6] for r in v), max(r[6] for r in v)) for k, v in want.items() if len(v) > 1}
    alone = dq.sharing_hash(df.where("source_id IS NULL").unionByName(df.limit(1)), ["batch_id"])
    assert alone.count() == 0
    tests = {r.test: r.failures for r in dq.schema_tests(df, ["leg"], unique=["entity_code", "batch_id"]).collect()}
    named = [r[0] for r in rows if r[0] is not None]
    assert tests["unique:entity_code"] == len(named) - len(set(named)) and tests["unique:batch_id"] == 0


def test_written_files_are_bounded_in_rows(spark, tmp_path, monkeypatch):
    """A file that one task must read whole has at most so many rows, however many rows a task writes."""
    from tallyspark.catalog import source_queries as Q
    monkeypatch.setattr(Q, "INVOICES", 1000)
    monkeypatch.setattr(Q, "PAGES", 1000)
    b = Books(spark, SF)
    rows = b.base().count()
    for read in (Q.xml_invoices, Q.journals):
        assert len(read(b).inputFiles()) >= rows / 1000


def test_fingerprints_are_counted_exactly(spark, monkeypatch):
    """Equal first bits of different digests, copies, and rows without a month."""
    from tallyspark.catalog import projection_queries as P
    same, rows = "0" * 12, []
    for month in (199901, 199902, None):
        rows += [(month, same + "a" * 52), (month, same + "b" * 52), (month, same + "b" * 52), (month, "f" * 64), (month, "1" * 64), (month, "1" * 64)]
    df = spark.createDataFrame(rows, "period_key int, row_hash string")
    monkeypatch.setattr(P, "staged", lambda b: df)
    got = {tuple(r) for r in P.fingerprints(None).collect()}
    assert got == {(m, int("f" * 12, 16), "f" * 64, same + "a" * 52, 4) for m in (199901, 199902, None)}


def test_source_lines_that_repeat_are_found_by_their_sides(spark):
    from tallyspark.operators import dq
    row = lambda source, leg, side, entity="A": (entity, "SAP_B1", source, leg, side)
    rows = [row("1-1", "S1", "D"), row("1-1", "S1", "C"), row("1-1", "S2", "D"), row("1-1", "S1", "D", "B"),
            row("2-1", "S1", "D"), row("2-1", "S1", "D"), row("3-1", "X", "D"), row("4-1", None, "C"), row("4-1", None, "C"), row("5-1", "S1", "D", None), row("5-1", "S1", "D", None)]
    postings = spark.createDataFrame(rows, "entity_code string, source_system string, source_id string, leg string, side string")
    assert sorted({r.source_id for r in dq.suspect_sources(postings).collect()}) == ["2-1", "3-1", "4-1", "5-1"]
    assert dq.suspect_sources(postings.where("source_id = '1-1'")).isEmpty()


def test_the_log_counts_repeated_source_rows(spark, books):
    """A line that came in twice counts once for each of its postings."""
    ledger = books.ledger().where("period_key <= 199503")
    failed = lambda rows: dq.dq_log(rows, books.accounts, books.fx_rates).where("rule_id = 'DQ-008'").agg(F.sum("records_failed"), F.sum("records_checked")).first()
    n = ledger.count()
    assert tuple(failed(ledger)) == (0, n)
    again = ledger.where("partkey % 10 = 0")
    assert tuple(failed(ledger.unionByName(again))) == (again.count(), n + again.count())


def test_source_duplicates_are_screened_by_line(spark, monkeypatch):
    """What is written before rows are looked up again is one hash per repeated line, not one per repeated posting."""
    written = []
    cut = dq.cut_lineage
    monkeypatch.setattr(dq, "cut_lineage", lambda df, label: written.append(cut(df, label)) or written[-1])
    row = lambda source, leg, side, batch: ("A", "SAP_B1", source, leg, side, batch, date(2000, 1, 1))
    sides = [(leg, side) for leg in ("S1", "S2", "S4") for side in "DC"]
    rows = [row("1-1", *s, b) for s in sides for b in ("b1", "b2")] + [row("2-1", *s, "b1") for s in sides] + [row("3-1", "X", "D", "b1")]
    df = spark.createDataFrame(rows, "entity_code string, source_system string, source_id string, leg string, side string, batch_id string, posting_date date")
    got = sorted((r.source_id, r.leg, r.side, r.occurrences, r.first_batch, r.last_batch) for r in dq.duplicate_sources(df).collect())
    assert got == sorted(("1-1", *s, 2, "b1", "b2") for s in sides)
    assert [w.count() for w in written] == [2]  # the repeated line, and the one of an unknown template


def test_merges_write_the_touched_partitions_once(spark, monkeypatch):
    """Copies of keys that no update names and rows without a key stay; what a merge writes lies nowhere else before or after."""
    written = []
    cut = sinks.cut_lineage
    monkeypatch.setattr(sinks, "cut_lineage", lambda df, label: written.append(label) or cut(df, label))
    path = fresh_path(spark, "touched")
    rows = lambda r: spark.createDataFrame(r, "id string, p int, v int")
    sinks.write_partitioned(rows([("a", 1, 1), ("d", 1, 2), ("d", 1, 3), ("d", 1, 3), (None, 1, 5), (None, 1, 5), ("e", 3, 1), ("m", 4, 4)]), path, "p", ["id"])
    load = rows([("a", 2, 9), ("a", 2, 8), (None, 1, 7), (None, 1, 8), ("m", 2, 0)])
    want = [("a", 2, 9), ("d", 1, 2), ("d", 1, 3), ("d", 1, 3), ("e", 3, 1), ("m", 2, 0), (None, 1, 5), (None, 1, 5), (None, 1, 8)]
    got = sinks.merge_partitions(path, load, ["id"], "p", ["id"]).select("id", "p", "v").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert written == ["updates"]
    assert sorted(n for n in sinks.names(spark, path) if not n.startswith(("_SUCCESS", "."))) == ["p=1", "p=2", "p=3"]


def test_a_streamed_merge_writes_a_batch_once(spark):
    """What a batch adds stays as it was written, whatever later batches change; versions decide, else the later batch; rows without a key are rivals in their batch alone."""
    import time
    columns = "id string, p int, v int, version int"
    path = fresh_path(spark, "corrections")
    loads = [[("a", 1, 1, 0), ("b", 1, 1, 0), (None, 1, 1, 0), (None, 1, 2, 0)], [("a", 2, 5, 2), ("b", 1, 3, 1), (None, 1, 1, 0)], [("a", 1, 4, 1), ("c", 3, 1, 0)]]
    for rows in loads:
        spark.createDataFrame(rows, columns).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    schema = spark.createDataFrame([], columns).schema
    stream = lambda: jobs.read_landed(spark, path, schema, 1)
    alone = [(None, 1, 1, 0), (None, 1, 2, 0)]
    for version, of_a in ((["version"], ("a", 2, 5, 2)), (None, ("a", 1, 4, 1))):
        fact = jobs.merge_table(stream(), "corrected", ["id"], "p", ["id"], version)
        assert sorted(map(tuple, fact.select("id", "p", "v", "version").collect()), key=str) == sorted([of_a, ("b", 1, 3, 1), ("c", 3, 1, 0), *alone], key=str)
        assert sum(pq.read_metadata(f.removeprefix("file://")).num_rows for f in fact.inputFiles()) == sum(map(len, loads))
        again = fact.groupBy("p", "id").count()._jdf.queryExecution().executedPlan().toString()
        assert again.count("Exchange") == 1  # rows lie by key already
    spark.createDataFrame([], columns).write.parquet(empty := fresh_path(spark, "nothing"))
    assert jobs.merge_table(jobs.read_landed(spark, empty, schema, 1), "empty", ["id"], "p", ["id"]).isEmpty()


def test_xml_files_are_compressed_and_read_back(spark):
    from tallyspark.catalog import source_queries as Q
    b = Books(spark, SF)
    read = Q.xml_invoices(b)
    assert all(f.endswith(".lz4") for f in read.inputFiles())
    of = lambda rows, *columns: sorted(map(tuple, rows.select(*columns).collect()))
    assert of(read, "szamlaszam", "brutto_osszeg", "fizetesi_mod") == sorted((r.invoice_no, r.gross, "BANK & cash") for r in Q.invoice_heads(b).collect())


def test_landed_and_streamed_tables_are_compact(spark):
    """zstd with ids as differences, and a partition column costs no sort: what a batch writes stays in its order."""
    rows = spark.range(2000).selectExpr("concat('order-of-a-line-', id) AS id", "id % 2 = 0 AS even")
    landed = jobs.land(rows, "compact", 1000)
    out = jobs.append_table(jobs.read_landed(spark, landed, rows.schema, 2), "compact-out", ["even"])
    for f in [*spark.read.parquet(landed).inputFiles(), *out.inputFiles()]:
        column = pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(0)
        assert column.compression == "ZSTD" and "DELTA_BYTE_ARRAY" in column.encodings
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, rows.collect()))
