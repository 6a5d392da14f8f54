"""SimHash, suffix repeats, vector searches, tokens, languages: against plain versions."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import components, deepsort, forest, langid, pieces, simhash, suffix, vectors, voronoi
from tests.llm import helpers
from tests.conftest import SF

MODEL = __import__("public_tokenizers").path("piece_bpe_32k.model")


def docs_of(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


# SimHash


def brute_components(rows):
    fps = [helpers.simhash(t) for _, t in rows]
    root = helpers.components(fps)
    least = {}
    for (i, _), r in zip(rows, root):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    return sorted(((i, f"{fp:016x}", least[r]) for (i, _), fp, r in zip(rows, fps, root)), key=str)


def found_components(docs):
    return sorted(((r.doc_id, r.f, r.component_id) for r in simhash.near_duplicates(docs).withColumn("f", simhash.as_hex(F.col("fp"))).collect()), key=str)


def test_simhash_on_documents(spark):
    docs = docs_of(spark)
    assert found_components(docs) == brute_components([(r.doc_id, r.text) for r in docs.collect()])


def test_simhash_on_odd_rows(spark):
    rows = helpers.odd_rows()
    docs = helpers.documents(spark, rows)
    assert found_components(docs) == brute_components([(i, t) for i, t, _, _ in rows])
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_links_of_planted_fingerprints(spark, monkeypatch):
    """Pairs at every place and distance, a chain, and one crowded anchor, with all limits on block sizes made small."""
    rng = random.Random(5)
    fps = {0, (1 << 64) - 1}
    for _ in range(120):
        a = rng.getrandbits(64)
        fps |= {a, a ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))}
    at = rng.getrandbits(64)
    for _ in range(40):
        at ^= sum(1 << b for b in rng.sample(range(64), 3))
        fps.add(at)
    crowd = rng.getrandbits(64)
    fps |= {crowd ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(300)}
    fps = sorted(fps)
    root = helpers.components(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    for block, pairs in ((4096, 1 << 21), (3, 7)):
        monkeypatch.setattr(simhash, "HOME_BLOCK", block)
        monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", pairs)
        edges = [(a, b) for batch in simhash._compare(3)(_sorted_replicas(np.array(signed, np.int64), 50 if block == 3 else 10 ** 6)) for a, b in zip(batch["a"], batch["b"])]
        parent = {s: s for s in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            assert bin((int(a) ^ int(b)) & ((1 << 64) - 1)).count("1") <= 3 * len(fps)
            parent[find(int(a))] = find(int(b))
        groups, want = {}, {}
        for s, r in zip(signed, root):
            groups.setdefault(find(s), set()).add(s)
            want.setdefault(r, set()).add(s)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def _sorted_replicas(fps, batch):
    import pandas as pd
    rows = pd.concat(list(simhash._replicas([pd.DataFrame({"fp": fps})]))).sort_values(["anchor", "away"])
    for i in range(0, len(rows), batch):
        yield rows[i:i + batch]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (7, 9)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1200)}


# suffix array


@settings(max_examples=40, deadline=None)
@given(st.binary(max_size=160).map(lambda b: bytes(x % 3 for x in b)), st.integers(1, 70))
def test_suffix_order(data, depth):
    padded = np.frombuffer(data + bytes(depth + 8), np.uint8)
    at = np.random.default_rng(len(data)).permutation(len(data)).astype(np.int64)
    order, group = deepsort.deep_shallow_sort(padded, at, depth)
    keys = [padded[at[i]:at[i] + depth].tobytes() for i in order]
    assert keys == sorted(keys)
    assert all((keys[i] == keys[i - 1]) == (group[i] == group[i - 1]) for i in range(1, len(keys)))


def cut_rows(frame):
    return sorted(((r["doc_id"], r["__n_bytes"], r["__n_removed"], len(r["__spans"]), r["__kept_sha256"]) for r in frame.collect()), key=str)


def brute_cut(rows):
    return sorted(((i, len((t or "").encode()), gone, spans, helpers.sha(kept)) for (i, t), (kept, gone, spans) in zip(rows, helpers.repeats(rows))), key=str)


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 20_000, "bucket_bytes": 5_000}])
def test_repeats_in_documents(spark, sizes):
    docs = docs_of(spark)
    assert cut_rows(suffix.remove_repeats(docs.repartition(3), **sizes)) == brute_cut([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_in_odd_rows(spark, seed):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randint(30, 130))) for _ in range(12)] + ["a" * 300, "ab" * 100]
    texts = [None, "", "x" * 49, "y" * 50] + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 4))) for _ in range(20)]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), "en", "s") for _ in range(150)]
    docs = helpers.documents(spark, rows).repartition(5)
    cut = suffix.remove_repeats(docs, chunk_bytes=3_000, bucket_bytes=700)
    assert cut_rows(cut) == brute_cut([(i, t) for i, t, _, _ in rows])
    kept = suffix.keep_first_occurrences(docs)
    assert kept.columns == docs.columns
    want = sorted(((i, k.decode("utf-8", "ignore")) for (i, _, _, _), (k, _, _) in zip(rows, helpers.repeats([r[:2] for r in rows]))), key=str)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == want
    assert suffix.keep_first_occurrences(docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [0, 500, 1 << 19])
def test_a_common_line_with_other_neighbours(spark, hot):
    """One line shorter than a window in every text: its keys are split, the largest bucket is bounded, and the result is the same."""
    rng = random.Random(7)
    around = lambda: "".join(rng.choice("abcdefgh ") for _ in range(60))
    line = "This line of boilerplate stands everywhere"
    same = around() + line + around()
    rows = [(i, same if i % 40 == 0 else around() + line + around(), "en", "s") for i in range(400)]
    docs = helpers.documents(spark, rows).repartition(4)
    cut = suffix.remove_repeats(docs, chunk_bytes=5_000, bucket_bytes=4_000, hot_windows=hot)
    assert cut_rows(cut) == brute_cut([(i, t) for i, t, _, _ in rows])
    chunks, buckets = suffix.cut_lineage(suffix.pack(docs, "doc_id", "text", 5_000), "test-chunks"), 16
    sent = chunks.select(*suffix.CORE).join(suffix.answered(chunks, buckets, hot), "chunk").mapInArrow(suffix._send(buckets), suffix.SEGMENT_SCHEMA)
    windows = {}
    for r in sent.collect():
        windows[r.bucket] = windows.get(r.bucket, 0) + sum(r.lengths)
    if hot <= 500:
        assert max(windows.values()) < 2 * sum(windows.values()) / buckets
    else:
        assert max(windows.values()) > 4 * sum(windows.values()) / buckets


# vectors


def odd_vectors(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(None, [1.0, 2.0]), (-20, [0.5] * 4), (1, None), (2, [float("nan")] * 4), (3, [float("inf"), 0.0, 0.0, 0.0]), (4, [None, 1.0, 1.0, 1.0]), (5, []), (6, [0.0] * 4), (7, [1.0]),
            (8, [1.0, 1.0, 1.0, 1.0, 1.0])]
    same = [rng.uniform(-1, 1) for _ in range(4)]
    rows += [(i, same if i % 3 == 0 else [rng.uniform(-1, 1) for _ in range(4)]) for i in range(20, n)] + [(40, same), (60, [0.1, 0.2, 0.3, 0.4])]
    return spark.createDataFrame([(i, v, 1, 1) for i, v in rows], "vec_id bigint, embedding array<double>, score int, block int"), rows


def brute_top(rows, scale, zero_too, k=20):
    import math
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero_too or any(v))]
    if scale:
        good = [(i, [math.floor(x * scale) for x in v]) for i, v in good]
    out = []
    for i, q in good:
        if i % 20 == 0:
            scores = sorted(((-math.fsum(a * b for a, b in zip(q, v)) if not scale else -sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def test_exact_top_k_on_odd_vectors(spark, monkeypatch):
    frame, rows = odd_vectors(spark)
    queries = frame.where("vec_id % 20 = 0")
    want = brute_top(rows, 64, True)
    assert sorted(map(tuple, voronoi.exact_top_k(frame, queries).collect())) == want
    monkeypatch.setattr(voronoi, "AT_ONCE", 7)
    assert sorted(map(tuple, voronoi.exact_top_k(frame, queries, pivots=5, sample_rows=30, block_rows=3, slice_rows=40).collect())) == want
    assert voronoi.exact_top_k(frame.limit(0), queries).count() == 0 and voronoi.exact_top_k(frame, queries.limit(0)).count() == 0


def test_scores_beyond_doubles_are_whole(spark):
    rows = [(0, [2.0 ** 23 + 1 / 64, 1.0]), (1, [2.0 ** 23 + 3 / 64, 1.0]), (2, [2.0 ** 23 + 3 / 64, 65 / 64]), (3, [2.0 ** 20, 0.5])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    want = brute_top(rows, 64, True)
    assert any(int(float(s)) != s for *_, s in want)
    assert sorted(map(tuple, voronoi.exact_top_k(frame, frame.where("vec_id = 0")).collect())) == want
    far = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30])], "vec_id bigint, embedding array<double>")
    assert [r.score for r in voronoi.exact_top_k(far, far.where("vec_id = 0")).sort("rank").collect()] == [2 ** 63 - 1, -2 ** 63]
    rows = [(0, [1e300]), (1, [1.0]), (2, [1e299]), (3, [-1e300]), (4, [1e308]), (5, [1e300])]
    huge = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = voronoi.exact_top_k(huge, huge.where("vec_id = 0"), slice_rows=1).sort("rank").collect()
    assert [r.vec_id for r in got] == [5, 2, 1, 3]  # equal once cut to 64 bits, ranked by what they are; 64 * 1e308 is not finite


def clustered(n, clusters=12, width=16, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((clusters, width)) * 3
    of = rng.integers(0, clusters, n)
    return centre[of] + rng.standard_normal((n, width)) * 0.05


def test_cells_that_cannot_hold_an_answer_are_not_sent(spark, monkeypatch):
    """Clustered vectors: the result is exact, and a row goes to few of the groups; a third of the rows are one vector, of one id in part."""
    x = clustered(1500)
    x[::3] = x[0]
    ids = [20 if i % 9 == 0 else i for i in range(len(x))]
    rows = list(zip(ids, x.tolist()))
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    dealt = []
    meet = voronoi.meet
    monkeypatch.setattr(voronoi, "meet", lambda sides, *a: dealt.append(sides[1]) or meet(sides, *a))
    queries = frame.where("vec_id % 20 = 0 AND vec_id <> 20")
    got = sorted(map(tuple, voronoi.exact_top_k(frame, queries, block_rows=20, slice_rows=200).collect()))
    assert got == [r for r in brute_top(rows, 64, True) if r[0] != 20]
    sent = dealt[0].agg(F.sum(F.length("ids") / 8).alias("n"), F.countDistinct("block").alias("blocks")).first()
    assert sent.n < 4 * len(rows) and sent.blocks > 5


def test_bounds_of_cells_hold():
    x = clustered(300) * 64
    p = voronoi.centres(x, 9)
    cell = voronoi.nearest_pivot(x, p)
    away = np.sqrt(((x - p[cell]) ** 2).sum(1))
    radius = np.array([away[cell == j].max() if (cell == j).any() else -1 for j in range(len(p))])
    near = [(int(cell[i]), int(i), float(away[i])) for j in range(len(p)) for i in np.flatnonzero(cell == j)[np.argsort(away[cell == j])][:6]]
    bound = voronoi.cell_bounds(p, radius, near, 5)
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    fifth = np.sort(scores, axis=1)[:, -5]
    assert (fifth >= bound[cell]).all() and np.isfinite(bound[np.unique(cell)]).all()
    assert (voronoi.cell_bounds(p, radius, near[:5], 5) == -np.inf).all()


def test_cells_are_packed_and_split():
    p = np.arange(8, dtype=float)[:, None]
    sizes = np.array([5, 0, 3, 40, 2, 9, 1, 0])
    first, parts = voronoi.packs(p, sizes, 10)
    assert parts[3] == 4 and (np.delete(parts, 3) == 1).all()
    load = {}
    for c in np.flatnonzero((sizes > 0) & (parts == 1)):
        load[first[c]] = load.get(first[c], 0) + sizes[c]
    assert max(load.values()) <= 10 and not set(load) & set(range(first[3], first[3] + 4))


def test_forest_with_all_rows_is_exact(spark):
    frame, rows = odd_vectors(spark)
    index = forest.HashForest(frame, slab_rows=100)
    got = sorted(map(tuple, index.search(frame.where("vec_id % 20 = 0"), share=forest.TREES).collect()))
    want = brute_top(rows, 0, False)
    assert [g[:3] for g in got] == [w[:3] for w in want] and np.allclose([g[3] for g in got], [w[3] for w in want], rtol=1e-15)
    assert forest.HashForest(frame.limit(0)).search(frame).count() == 0 and index.search(frame.limit(0)).count() == 0


@pytest.mark.parametrize("n,copies", [(2, 0), (10, 0), (15, 0), (30, 0), (200, 16)])
def test_forest_finds_k_rows_with_the_production_share(spark, n, copies):
    """Unit vectors; all rows are queries, every third id stands twice, and `copies` rows are the same vector."""
    x = np.random.default_rng(n).standard_normal((n, 16))
    x[:copies] = x[0]
    x /= np.sqrt((x ** 2).sum(1, keepdims=True))
    ids = [i - i % 3 // 2 for i in range(n)]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id bigint, embedding array<double>")
    for slab_rows in (forest.SLAB_ROWS, 7):
        found = {}
        for r in forest.HashForest(frame, slab_rows=slab_rows).search(frame).collect():
            found.setdefault(r.query_id, []).append(r.rank)
        assert {i: len(found.get(i, [])) for i in ids} == {i: ids.count(i) * min(20, n - ids.count(i)) for i in ids}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_forest_recall(spark, sf):
    frame = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = frame.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = {}
    for r in forest.HashForest(frame).search(frame.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        best = set(ids[np.lexsort((ids, -s))[:20]].tolist())
        hits, total = hits + len(best & set(got[ids[i]])), total + len(best)
    assert hits / total >= 0.9


def test_prefixes_narrow_with_depth():
    codes = np.sort(np.random.default_rng(1).integers(0, 1 << 32, 500, dtype=np.uint64))
    for depth in (0, 1, 5, 32):
        low, high = forest.prefix_range(codes, codes[:50], depth, 32)
        for c, a, b in zip(codes[:50], low, high):
            assert set(range(a, b)) == set(np.flatnonzero(codes >> np.uint64(32 - depth) == c >> np.uint64(32 - depth)) if depth else range(500))


def test_short_vectors_are_filled(spark):
    import pyarrow as pa
    assert vectors.matrix(pa.array([[1.0], [], [1.0, 2.0]]), 2).tolist() == [[1, 0], [0, 0], [1, 2]]


# tokens


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "the", "ing", "é", "▁", "😀", "中", "<s>", "<0x0A>", "0", "==", "ll", "ab", "\x00", "Th", "ss", "ſ"]), max_size=40).map("".join))
def test_tokens_are_the_library_s(library, text):
    model = pieces.model(MODEL)
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert model.encode(text) == ids and model.decode(ids) == library.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_tokens_of_any_text(library, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert pieces.model(MODEL).encode(text) == ids and pieces.model(MODEL).decode(ids) == library.decode(ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 31_999), max_size=30))
def test_any_ids_decode_like_the_library(library, ids):
    assert pieces.model(MODEL).decode([i for i in ids if i != 0]) == library.decode([i for i in ids if i != 0])


def test_tokens_of_documents(spark, library):
    docs = docs_of(spark).unionByName(helpers.documents(spark, helpers.odd_rows()).select(*docs_of(spark).columns))
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        want.append((str(r.doc_id), len(ids), helpers.sha(np.array(ids, "<u4").tobytes()), helpers.sha(library.decode(ids).encode())))
    got = pieces.token_digests(pieces.tokenize(docs, MODEL))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == sorted(want)
    assert pieces.tokenize(docs.limit(0), MODEL).count() == 0


def test_caches_may_turn_over(library, monkeypatch):
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 3)
    model = pieces.PieceModel(MODEL)
    text = "one two three four one two five six seven one nothing's internationalization"
    for _ in range(3):
        assert model.encode(text) == library.encode(text, add_bos=True, add_eos=True)


# languages


def test_language_accuracy_on_rows_not_learned_from(spark):
    docs = docs_of(spark, "/root/testdata/sf0.01")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    rows = langid.predict(docs, model, "doc_id", "lang").where(langid.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.rejected for r in rows)


def test_language_of_odd_rows(spark):
    docs = helpers.documents(spark, helpers.odd_rows()).withColumn("score", F.lit("clash"))
    model = langid.fit(docs)
    assert model.langs == ["de", "en", "fr"]
    rows = langid.predict(docs, model, "doc_id", "text").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and (r.lang_pred != "und" or (r.rejected and r.score == 0))
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(not r.rejected for r in rows)
    assert langid.predict(docs.limit(0), model, "doc_id").count() == 0


def test_language_without_training_rows(spark):
    docs = helpers.documents(spark, [(1, "the thing", None, "a")])
    model = langid.fit(docs)
    assert [(r.lang_pred, r.score, r.rejected) for r in langid.predict(docs, model, "doc_id").collect()] == [("und", 0.0, True)]


def test_sample_is_bounded_and_refits_agree(spark):
    docs = docs_of(spark, "/root/testdata/sf0.01")
    assert max(r["count"] for r in langid.training_rows(docs, 7).groupBy("lang").count().collect()) == 7
    a, b = langid.fit(docs, 20), langid.fit(docs.repartition(5), 20)
    assert a.langs == b.langs and np.array_equal(a.vectors, b.vectors) and np.array_equal(a.idf, b.idf)


def test_strange_scripts_are_rejected(spark):
    docs = docs_of(spark)
    model = langid.fit(docs)
    assert model.predict("漢字仮名交じり文漢字仮名交じり文" * 5)[2] and not model.predict("the thing of and on")[2]


FOREIGN = {
    "chinese": "中国是世界上历史最悠久的国家之一。中国各族人民共同创造了光辉灿烂的文化，具有光荣的革命传统。",
    "russian": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в духе братства.",
    "finnish": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava "
               "toisiaan kohtaan veljeyden hengessä.",
    "hungarian": "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben "
                 "testvéri szellemben kell hogy viseltessenek.",
    "junk": "xqzv kjwq zzxk qqpw vvkx jjqz wxkq pzvq kkxj qwzx " * 6,
}


def test_one_training_text_does_not_switch_rejection_off(spark):
    """Foreign scripts, foreign languages in Latin letters and junk, with texts of one word (and one in a foreign script) learned from too."""
    docs = docs_of(spark, "/root/testdata/sf0.1").where("doc_id is not null").select("doc_id", "text", "lang")
    learned = docs.where(~langid.held_out(F.col("doc_id")) & (F.col("doc_id") % 5 == 0))
    odd = [(10 ** 9 + i, t, lang) for i, (t, lang) in enumerate([("Mentmentan.", "fr"), ("Zw.", "de"), ("Qui", "es"), ("Xylk", "en"), (FOREIGN["chinese"], "fr")])]
    model = langid.fit(learned.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string, lang string")), 10 ** 4)
    assert model.limits.max() < 1
    assert {k: model.predict(t)[2] for k, t in FOREIGN.items()} == dict.fromkeys(FOREIGN, True)
    rows = langid.predict(docs, model, "doc_id", "lang").where(langid.held_out(F.col("doc_id"))).collect()
    assert sum(r.rejected for r in rows) <= len(rows) / 500 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98


def test_op8_tells_what_is_rejected(spark):
    from tallyspark.llm import catalog
    assert "rejected" in catalog.queries()["op8_langid"](spark, SF).columns


def test_grams_do_not_depend_on_pieces(monkeypatch):
    text = langid.letters("Ünder the größte ÉTÉ 12 x" * 50)
    whole = langid.gram_counts(text)
    monkeypatch.setattr(langid, "PIECE", 7)
    assert np.array_equal(whole, langid.gram_counts(text)) and whole.sum() == 3 * len(text) - 3


def test_every_language_keeps_several_centroids(spark):
    """At sf0.1, where parts of a language are much alike; no cluster is small, and no two are the same."""
    docs = docs_of(spark, "/root/testdata/sf0.1")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    per = {lang: model.vectors[model.owner == i] for i, lang in enumerate(model.langs)}
    assert set(per) == {"en", "fr", "de", "es"} and all(len(v) >= 2 for v in per.values())
    rng = np.random.default_rng(0)
    x = np.abs(rng.normal(size=(50, 30)))
    x /= np.sqrt((x ** 2).sum(1, keepdims=True))
    x[0] = np.eye(30)[0]  # one text unlike all others is no cluster
    centre = langid._means(x, 3)
    sizes = np.bincount((x @ centre.T).argmax(1), minlength=len(centre))
    assert len(centre) >= 2 and sizes.min() >= 2
    assert len(langid._means(x[:4], 3)) == 2 and len(langid._means(x[:1], 3)) == 1


def sampled(rows, per=10):
    got = {}
    for r in rows:
        got.setdefault(r.lang, []).append(r.text)
    return {lang: len(t) for lang, t in got.items()}, got


def test_sample_with_hot_ids_and_letterless_rows(spark):
    """Thousands of copies of one row, of one id, and of rows without a letter take nothing from the sample, which stays bounded."""
    rows = [(1, "one and the same", "aa")] * 3000 + [(i, f"text of {'abcdefghijklmnop'[i % 16]} {i}", "aa") for i in range(10, 40)]
    rows += [(i, "123 456", "bb") for i in range(5000)] + [(9000 + i, "bb word " + "x" * i, "bb") for i in range(12)]
    rows += [(5, f"under one id {i}", "cc") for i in range(2000)] + [(None, "no id", "dd"), (3, "three", None), (7, None, "ee"), (8, "only", "ff")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    counts, texts = sampled(langid.training_rows(docs, 10).collect())
    assert counts == {"aa": 10, "bb": 10, "cc": 10, "ff": 1}
    assert all(len(set(t)) == len(t) for t in texts.values())
    again = sampled(langid.training_rows(docs.repartition(13), 10).collect())[1]
    assert {k: sorted(v) for k, v in again.items()} == {k: sorted(v) for k, v in texts.items()}


def plain_judgement(model, text):
    """Nearest centroid gram by gram, with plain integers."""
    mask = 0xFFFFFFFF
    kept = "".join(c for c in (text or "") if c.isalpha())
    if not kept:
        return "und", 0.0
    codes, counts = [ord(c) for c in langid.letters(text)], {}
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            h = codes[i] * 0x9E3779B1 & mask
            for c in codes[i + 1:i + n]:
                h = ((h ^ h >> 15) * 0x85EBCA77 + c * 0xC2B2AE3D) & mask
            m = ((h ^ h >> 13) * 0x27D4EB2F + n) & mask
            g = (m >> 16) % langid.DIMENSIONS
            counts[g] = counts.get(g, 0) + 1
    weights = {g: n ** 0.5 * model.idf[g] for g, n in counts.items()}
    norm = sum(w * w for w in weights.values()) ** 0.5
    best = max(range(len(model.owner)), key=lambda j: sum(w * model.vectors[j][g] for g, w in weights.items()))
    return model.langs[model.owner[best]], sum(w * model.vectors[best][g] for g, w in weights.items()) / norm


def test_predictions_equal_a_plain_scorer(spark):
    docs = docs_of(spark)
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    clashing = docs.withColumn("__lang", F.lit(1)).withColumn("lang_pred", F.lit("x"))
    assert langid.keep_identified(clashing, model).columns == clashing.columns
    for r in langid.predict(docs.where("length(text) < 4000"), model, "doc_id", "text").collect():
        lang, score = plain_judgement(model, r.text)
        assert (r.lang_pred, r.score) == (lang, pytest.approx(score, abs=1e-9))
