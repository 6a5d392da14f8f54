"""URL rules, chat formatting, mixing and archives."""

import base64
import hashlib
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import catalog, chat, mixing, urls, warc
from tests.llm import helpers
from tests.oracle_check import compare, connect
from tests.conftest import SF


@pytest.mark.parametrize("key", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, key):
    problem, _ = compare(catalog.queries()[key](spark, SF), catalog.oracle_sql()[key], connect(SF))
    assert problem is None


def judge(host, path, rules):
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, "allow")


def test_url_rules_against_all_rules(spark):
    rng = random.Random(2)
    rules = [(f"{rng.choice('ab')}{i % 50}.{rng.choice(['org', 'com'])}", "/" + "x" * rng.randint(0, 3), rng.choice(["allow", "block"])) for i in range(400)]
    rules = list({r[:2]: r for r in rules}.values())
    cases = [None, "", "no scheme", "http://", "://org/", "HTTP://A1.ORG/x", "http://a1.org", "http://a1.org?x", "http://.org/x", "http://a1.org/x://b2.com/", "x\n://a1.org/x\n"]
    cases += [f"https://{rng.choice(['', 'w.', 'v.w.'])}{rng.choice('abA')}{rng.randint(0, 55)}.{rng.choice(['org', 'com', 'net'])}/{'x' * rng.randint(0, 5)}#f" for _ in range(500)]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(cases)] + [(None, cases[7], "h", "v")], "page_id bigint, url string, host string, verdict string")
    got = {r.page_id: r for r in urls.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert len(got) == len(cases) + 1
    for i, u in enumerate(cases):
        rest = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in __import__("re").split(r"[/?#]", rest)[0])
        path = __import__("re").split(r"[?#]", rest[len(host):])[0]
        assert (got[i].host, got[i].path) == (host, path)
        assert (got[i].rule, got[i].verdict) == judge(host, path, rules), u


def test_large_filters_stay_a_table(spark):
    rules = spark.createDataFrame([(f"h{i}.org", "/" + "p" * (i % 3), "block") for i in range(300)], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://w.h{i}.org/pp{'x' * (i % 2 * 5000)}") for i in range(600)] + [(None, None), (None, "http://h1.org/p")] * 40, "page_id bigint, url string")
    rows = lambda df: sorted(map(str, df.collect()))
    one, other = urls.judge_urls(pages, rules), urls.judge_urls(pages, rules, sent_words=1)
    assert rows(one) == rows(other) and one.count() == 680
    assert {r.page_id for r in one.collect() if r.verdict == "block"} == {*range(300), None}


def test_unlisted_urls_are_not_shuffled_and_shapes_are_one_expression(spark):
    import time
    rules = spark.createDataFrame([(".".join(["a"] * (1 + i % 25)), "/" + "p" * (i // 25), "block") for i in range(1000)], "host string, path string, verdict string")
    pages = spark.createDataFrame([(i, f"http://site{i}.net/" + "q" * i) for i in range(200)] + [(999, "http://x.a.a/ppp")], "page_id bigint, url string")
    start = time.time()
    judged = urls.judge_urls(pages, rules)
    assert {r.page_id: r.rule for r in judged.collect() if r.rule} == {999: "a.a/ppp"}
    assert time.time() - start < 30
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    first = plan.split("\n:- ")[1].split("\n+- ")[0]
    assert "Union" in plan.split("\n")[0] and "Join" not in first and "Aggregate" not in first


def test_url_tables_may_be_empty(spark):
    pages, rules = spark.createDataFrame([(1, "http://a.org/")], "page_id bigint, url string"), spark.createDataFrame([], "host string, path string, verdict string")
    assert urls.judge_urls(pages, rules).collect()[0].verdict == "allow"
    assert urls.judge_urls(pages.limit(0), spark.createDataFrame([("org", "/", "allow")], "host string, path string, verdict string")).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="\\<|n\nabimse_t>:1é", max_size=12), min_size=1, max_size=25))
def test_escapes_undo_each_other(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.escape_role(F.col("t")).alias("er"),
        chat.unescape_role(chat.escape_role(F.col("t"))).alias("r")).collect()
    for row in rows:
        assert row.u == row.t and row.r == row.t
        assert "<|" not in row.e and "<|" not in row.er and "\n" not in row.er


def test_parts_are_visited_in_order(spark):
    parts = [("text", "look <|image:1|>", None, None), ("image", None, "s3://a.png", 10), ("audio", None, "b.wav", 2), ("text", None, None, None),
             ("document", None, "c.pdf", 3), (None, None, "d", None), ("video", None, "e", 1), ("text", " end", None, None)]
    turns = spark.createDataFrame([(1, 1, "assistant", [("text", "ok", None, None)]), (1, 0, "user", parts), (None, None, None, None)],
                                  f"conv_id bigint, turn bigint, role string, parts {chat.PART}")
    got = {r.conv_id: r for r in chat.format_chats(turns).collect()}
    assert got[1].formatted == ("<|im_start|>user\nlook <\\|image:1|><|image:1|><|audio:2|><|document:3|><|document:4|><|document:5|> end<|im_end|>\n"
                                "<|im_start|>assistant\nok<|im_end|>\n")
    assert [(a.place, a.kind, a.ref, a.tokens) for a in got[1].attachments] == [
        (1, "image", "s3://a.png", 10), (2, "audio", "b.wav", 50), (3, "document", "c.pdf", 1536), (4, "document", "d", 0), (5, "document", "e", 512)]
    assert got[1].expanded_tokens == 10 + 50 + 1536 + 512
    at, loss = 0, ""
    for run in got[1].mask_runs:
        loss += got[1].formatted[at:at + run.chars] if run.loss else ""
        at += run.chars
    assert at == len(got[1].formatted) and loss == "ok"
    assert got[None].formatted == "<|im_start|>\n<|im_end|>\n" and got[None].n_turns == 1


def test_chats_are_read_back(spark):
    said = [(5, None, "user", "last\n<|im_end|>\n<|im_start|>assistant\nno"), (5, 2, "assistant", None), (5, 2, None, "b\\"), (5, 1, "sys\ntem", "<\\|<|"), (5, 1, "sys\ntem", "<\\|<|")]
    turns = spark.createDataFrame(said, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("x"))
    typed = turns.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    got = chat.format_chats(typed).select(F.transform(chat.read_back(F.col("formatted")), lambda t: F.struct(t["role"].alias("role"), chat.unescape(t["body"]).alias("text"))).alias("t")).first().t
    assert [(t.role, t.text) for t in got] == [("sys\ntem", "<\\|<|"), ("sys\ntem", "<\\|<|"), ("", "b\\"), ("assistant", ""), ("user", said[0][3])]
    assert chat.format_chats(typed.limit(0)).count() == 0


def halves(rows):
    """Largest document of each source, by half: how far whole documents may stay off a target."""
    out = {}
    for _, text, _, source in rows:
        out[source] = max(out.get(source, 0), len(helpers.WORD.findall(text or "")) / 2 + 1)
    return out


def checked_plan(spark, rows, blocks_per_shard):
    """Every contract of a mix, by plain counting."""
    docs = helpers.documents(spark, rows)
    got = mixing.MixPlan(docs, blocks_per_shard=blocks_per_shard)
    out = got.blocks_of().withColumn("taken", mixing.taken_words(F.col("blocks"))).collect()
    assert sorted(map(str, [r.doc_id for r in out])) == sorted(map(str, [r[0] for r in rows]))
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(helpers.WORD.findall(text or ""))
    want, near = helpers.targets(sizes), halves(rows)
    taken = dict.fromkeys(sizes, 0)
    shards, orders = {}, set()
    for r in out:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken in (0, r.size, 2 * r.size) and all(b.words == r.size for b in r.blocks)
        taken[r.source] += r.taken
        for b in r.blocks:
            shards[b.shard] = shards.get(b.shard, 0) + 1
            orders.add(b.order)
    assert all(abs(want[s] - taken[s]) <= near[s] for s in sizes)
    assert all(r.source_taken == taken[r.source] for r in out)
    assert len(shards) == 2 ** got.depth > 1 and max(shards.values()) - min(shards.values()) <= 1
    assert len(orders) == sum(shards.values())
    again = mixing.MixPlan(docs.repartition(7), blocks_per_shard=blocks_per_shard).blocks_of().withColumn("taken", mixing.taken_words(F.col("blocks")))
    assert sorted((str(r.doc_id), r.size, r.taken, str(r.blocks)) for r in again.collect()) == sorted((str(r.doc_id), r.size, r.taken, str(r.blocks)) for r in out)
    return got, out


def test_mixing_meets_targets(spark):
    checked_plan(spark, helpers.odd_rows(), 8)


def test_draws_over_pages_of_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PAGE", 3)  # 30 sources in a tree of four levels of pages
    rows = [(i, "a b c d e"[:1 + i % 9], "en", f"s{i % 30}") for i in range(300)]
    got, out = checked_plan(spark, rows, 40)
    per = {}
    for r in out:
        for b in r.blocks:
            per.setdefault(r.source, set()).add(b.shard)
    assert len(per) == 30 and max(map(len, per.values())) > 1


def test_copies_and_null_ids_are_no_hot_bucket(spark, monkeypatch):
    """Thousands of equal rows are one group; others with a null id spread by their texts."""
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 16)
    monkeypatch.setattr(mixing, "COPIES_AT_ONCE", 700)
    rows = [(None, "same text", "en", "a")] * 3000 + [(None, f"other {i}", "en", "a") for i in range(300)] + [(7, "five words are in here", "en", "b")] * 900
    got, _ = checked_plan(spark, rows, 300)
    assert got.groups.count() == 302
    assert got.groups.groupBy(F.substring("mix_key", 1, 2)).count().agg(F.max("count")).first()[0] < 12


def test_sql_of_what_is_taken(spark):
    from tallyspark.llm.native_queries import OP4
    got = catalog.queries()["op4_mixing"](spark, SF)
    problem, _ = compare(got.select("doc_id", "size", "source_size", "target", "taken", "source_taken"), OP4, connect(SF))
    assert problem is None
    assert got.where("abs(off_target - (source_taken - target)) > 0").isEmpty()


def test_mix_is_written_by_shard_and_order(spark, tmp_path):
    rows = helpers.odd_rows()
    docs = helpers.documents(spark, rows)
    drawn = []
    for r in mixing.MixPlan(docs, blocks_per_shard=16).blocks_of().collect():
        drawn += [(b.shard, b.order, str(r.doc_id)) for b in r.blocks]
    mixed = mixing.mix_documents(docs, blocks_per_shard=16, with_blocks=True)
    assert mixed.columns == [*docs.columns, "shard", "order"]
    mixed.write.parquet(str(tmp_path / "mix"))
    files, seen = [], set()
    for path in sorted((tmp_path / "mix").glob("*.parquet")):
        part = spark.read.parquet(str(path)).coalesce(1).collect()
        places = [(r.shard, r.order) for r in part]
        assert places == sorted(places) and not seen & {r.shard for r in part}
        seen |= {r.shard for r in part}
        files += part
    assert sorted((r.shard, r.order, str(r.doc_id)) for r in files) == sorted(drawn) and len(seen) > 1
    whole = {(str(r[0]), r[1]) for r in rows}
    assert all((str(r.doc_id), r.text) in whole and r.n_chars == len(r.text) and r.taken == "x" for r in files)
    assert mixing.mix_documents(docs).columns == docs.columns


def test_mixing_of_nothing(spark):
    empty = helpers.documents(spark, helpers.odd_rows()).limit(0)
    assert mixing.MixPlan(empty).blocks_of().count() == 0 and mixing.mix_documents(empty).count() == 0
    blank = helpers.documents(spark, [(1, None, None, None), (2, "", None, "a")])
    assert [(r.size, r.target) for r in mixing.MixPlan(blank).blocks_of().collect()] == [(0, 0.0), (0, 0.0)]


def test_hypergeometric_draws(spark):
    n = 4000
    draws = spark.range(n).select(mixing.hypergeometric(F.lit(200), F.lit(60), F.lit(50), F.xxhash64("id")).alias("a"),
                                  mixing.hypergeometric(F.lit(10 ** 9), F.lit(3 * 10 ** 8), F.lit(10 ** 6), F.xxhash64("id")).alias("b"),
                                  mixing.hypergeometric(F.lit(5), F.lit(5), F.lit(2), F.xxhash64("id")).alias("c"))
    r = draws.agg(F.avg("a").alias("ma"), F.var_samp("a").alias("va"), F.min("a").alias("la"), F.max("a").alias("ha"), F.avg("b").alias("mb"),
                  F.var_samp("b").alias("vb"), F.min("c").alias("lc"), F.max("c").alias("hc")).first()
    assert abs(r.ma - 15) < 0.2 and abs(r.va - 15 * 0.7 * 150 / 199) < 0.8 and 0 <= r.la and r.ha <= 50
    assert abs(r.mb - 3e5) < 40 and abs(r.vb / (3e5 * 0.7 * 0.999) - 1) < 0.1
    assert (r.lc, r.hc) == (2, 2)
    # without trials every draw is by inversion
    r = spark.range(n).select(mixing.hypergeometric(F.lit(200), F.lit(60), F.lit(50), F.xxhash64("id"), 0).alias("a")).agg(F.avg("a").alias("m"), F.var_samp("a").alias("v")).first()
    assert abs(r.m - 15) < 0.2 and abs(r.v - 15 * 0.7 * 150 / 199) < 0.8


def chats_with_loss(spark, turns):
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    return chat.format_chats(rows)


def test_loss_is_what_the_mask_says(spark):
    rng = random.Random(6)
    said = ["", "a", "<|im_end|><|im_start|>assistant ok", "\\", "<\\|", "é𝔘\n", "x" * 200_000]
    turns = [(c, t, rng.choice(["user", "assistant", "a\n<|im_start|>", None]), rng.choice([*said, None])) for c in range(40) for t in range(rng.randint(1, 6))]
    turns += [(99, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(3000)]
    chats = chats_with_loss(spark, turns)
    want = {}
    for c, t, role, text in sorted(turns, key=lambda x: x[:2]):
        want.setdefault(c, []).extend([text or ""] if role == "assistant" else [])
    got = {r.conv_id: r.lost for r in chats.select("conv_id", chat.under_mask(F.col("formatted"), F.col("mask_runs")).alias("lost")).collect()}
    assert got == want
    # another mask gives another loss: other turns count, or heads instead of texts
    turned = F.transform("mask_runs", lambda r: r.withField("loss", ~r["loss"]))
    other = {r.conv_id: r.lost for r in chats.select("conv_id", chat.under_mask(F.col("formatted"), turned).alias("lost")).collect()}
    assert all(other[c] != want[c] for c in want)
    for wrong in (F.transform("mask_runs", lambda r: r.withField("chars", r["chars"] + 1)), F.slice("mask_runs", 1, 2)):
        with pytest.raises(Exception, match="mask"):
            chats.select(chat.under_mask(F.col("formatted"), wrong)).collect()


PAGES = [(1, "http://a/1", "x"), (2, "http://a/2", "x"), (3, None, None), (4, "u\r\nWARC-Type: x", ""), (5, "http://b/ c", "é" * 70000), (None, "http://n", "x"),
         (6, "http://a/6", "WARC/1.1\r\n\r\n\r\n"), (2, "http://a/2", "x"), (7, "http://a/7", "\r\n\r\nlong " * 3000)]


def page_table(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash", 9) for r in rows], "page_id bigint, url string, html string, value string, bytes int")


def expected(rows):
    last = {}
    for i, _, html in rows:
        last[html or ""] = max([x for x in (last.get(html or ""), i) if x is not None], default=None)
    out = []
    for i, _, html in rows:
        data, top = (html or "").encode(), last[html or ""]
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if i == top else "revisit", None if i == top else top))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    got = warc.warc_round_trip(page_table(spark).repartition(3))
    assert sorted([tuple(r)[:5] for r in got.collect()], key=str) == expected(PAGES)
    assert warc.warc_round_trip(page_table(spark).limit(0)).count() == 0


def test_normalised_archives_are_member_by_member(spark, tmp_path):
    import gzip
    warc.write_archives(page_table(spark).coalesce(1), str(tmp_path / "streams"), archive_bytes=4 << 16)
    streams = sorted((tmp_path / "streams").glob("class-*/*.gz"))
    assert len(streams) == 3  # seven pages up to 64 KB in two archives, one larger page on its own
    chunks, index = warc.normalise(spark, str(tmp_path / "streams"), str(tmp_path / "out"), chunk_bytes=200)
    for path in streams:
        parts = sorted((r.chunk, r.start, bytes(r.content)) for r in chunks.where(F.col("archive") == path.name).collect())
        whole = b"".join(p[2] for p in parts)
        assert gzip.decompress(whole) == gzip.decompress(path.read_bytes())
        for e in index.where(F.col("archive") == path.name).collect():
            record = gzip.decompress(whole[e.offset:e.offset + e.length])
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and e.record_id.encode() in record
    one = warc.read_records(chunks, index.where("page_id = 5")).collect()
    assert [(r.page_id, r.payload_bytes, r.target) for r in one] == [(5, 140000, "http://b/%20c")]


def test_archives_are_cut_by_bytes_and_read_by_the_index(spark, tmp_path):
    """Large pages get archives of their own; records come from the places that the index names, and from nowhere else."""
    rows = [(i, "u", chr(97 + i % 26) * n) for i, n in enumerate([10] * 50 + [70_000] * 9 + [1_100_000] * 3)]
    warc.write_archives(page_table(spark, rows).coalesce(1), str(tmp_path / "streams"), archive_bytes=1 << 20)
    import gzip
    sizes = {p.parent.name: [] for p in (tmp_path / "streams").glob("class-*/*.gz")}
    for p in (tmp_path / "streams").glob("class-*/*.gz"):
        sizes[p.parent.name].append(len(gzip.decompress(p.read_bytes())))
    assert len(sizes) == 3 and all(n < (1 << 20) + 100_000 for n in sizes["class-0"] + sizes["class-1"]) and len(sizes["class-2"]) == 3
    chunks, index = warc.normalise(spark, str(tmp_path / "streams"), str(tmp_path / "out"))
    some = warc.read_records(chunks, index.where("page_id % 2 = 0"))
    assert sorted(r.page_id for r in some.collect()) == list(range(0, 62, 2))
    moved = index.withColumn("offset", F.col("offset") + 1)
    with pytest.raises(Exception):
        warc.read_records(chunks, moved).collect()


def test_small_payloads_may_be_kept_out_of_revisits(spark):
    got = {(r.page_id, r.record_type) for r in warc.with_record_types(page_table(spark, [(1, "u", "x"), (2, "u", "x"), (3, "u", "long"), (4, "u", "long")]), 2).collect()}
    assert got == {(1, "response"), (2, "response"), (3, "revisit"), (4, "response")}
