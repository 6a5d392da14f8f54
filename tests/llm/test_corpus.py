"""Spelling variants, Merkle proofs and secret scans: against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallyspark.llm import merkle, secrets, spelling
from tallyspark.session import fresh_path
from tests.llm import helpers


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# Spelling variants


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = max(a, b, key=len), min(a, b, key=len)
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def variants_of(counts):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if x != w and abs(len(x) - len(w)) < 2 and one_apart(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        out[w] = (best if best and counts[best] >= 2 * n else None, n, len(near))
    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w
    return {w: (f, root(w), n, k, counts[f] if f else None) for w, (f, n, k) in out.items()}


def plain_words(rows):
    counts = collections.Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = ascii_lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def got_variants(frame):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()}


def test_spelling_on_odd_documents(spark):
    rng = random.Random(7)
    letters = "abcAÉéÿ÷z"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)]
    texts = []
    for i in range(200):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(stems[:rng.randint(1, 60)])
            p = rng.randrange(len(w))
            words.append(rng.choice([w, w, w[:p] + w[p + 1:], w[:p] + rng.choice(letters) + w[p:], w[:p] + rng.choice(letters) + w[p + 1:]]))
        texts.append(rng.choice([" ", "-", "\n", "ŝ"]).join(words))
    long = "x" * 5000
    texts += [None, "", "123", " ".join([long, long + "y", "z" + long, long[:2500] + "q" + long[2501:]] * 3), " ".join(["aaaaa aaaaaa baaaa aabaa"] * 9),
              " ".join(["chain"] * 3 + ["chainq"] * 7 + ["chainqq"] * 20 + ["chainqqq"] * 50)]
    rows = [(i if i % 9 else None, t, "en", "s") for i, t in enumerate(texts)]
    rows += rows[:20]
    docs = helpers.documents(spark, rows)
    want = variants_of(plain_words(rows))
    assert sum(v[3] > 0 for v in want.values()) > 50 and any(v[1] not in (w, v[0]) for w, v in want.items())
    assert got_variants(spelling.spelling_variants(docs)) == want
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


def test_crowded_signatures_lose_no_pair(spark):
    """Words over two letters share few multisets; with a small limit nearly all groups are dealt out by deletions, over many batches."""
    rng = random.Random(8)
    words = {"".join(rng.choice("ab") for _ in range(rng.randint(5, 9))) for _ in range(400)} | {"é" + "ab" * 40, "é" + "ab" * 40 + "a", "ab" * 40 + "é"}
    counts = {w: rng.randint(3, 40) for w in words}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    want = {w: (v[3], v[0], v[4]) for w, v in variants_of(counts).items() if v[3]}
    for limit in (3, 50, 1024):
        got = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(frame, limit).collect()}
        assert got == want, limit


def test_groups_are_whole_and_bounded(monkeypatch):
    monkeypatch.setattr(spelling, "ROWS_AT_ONCE", 8)
    rng = random.Random(9)
    keys = sorted(rng.choice([1, 2, 3, 4, 5, 5, 5, 5, 5, 9]) for _ in range(200))
    batches = [pa.record_batch([pa.array(keys[i:i + 7], pa.int64())], names=["k"]) for i in range(0, 200, 7)]
    whole, apart = collections.Counter(), collections.Counter()
    for table, starts in spelling._groups(iter(batches), "k", 20):
        found = table["k"].to_pylist()
        (apart if starts is None else whole).update(found)
        if starts is not None:
            assert list(starts) == [0] + [i for i in range(1, len(found)) if found[i] != found[i - 1]]
    sizes = collections.Counter(keys)
    assert dict(whole) == {k: n for k, n in sizes.items() if n <= 20} and dict(apart) == {k: n for k, n in sizes.items() if n > 20}


def test_signatures_of_long_words_fit_short_ones():
    parts = spelling.PlaceParts((spelling.mixed(np.arange(256 * spelling.PLACES, dtype=np.uint64)) % np.uint64(spelling.PARTS)).astype(np.int64))
    word = "abcdeabcdea" * 4 + "xyzé"
    assert len(word) <= spelling.MATRIX < len(word) + 1
    near = word + "q"
    a, _ = spelling.signatures(pa.array([word.encode("latin-1")]), parts)
    both, _ = spelling.signatures(pa.array([word.encode("latin-1"), near.encode("latin-1")]), parts)
    assert (both[0] == a[0]).all() and (both[0] == both[1]).any()


# Merkle proofs


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def path_of(levels, i):
    """(place, siblings) per level."""
    out = []
    for level in levels[:-1]:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        out.append((i % 3, run[:i % 3] + run[i % 3 + 1:]))
        i //= 3
    return out


def fold(digest, path):
    for place, others in path:
        digest = sha("".join(others[:place] + [digest] + others[place:]))
    return digest


def plain_proofs(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    by_source = collections.defaultdict(list)
    for i, t, lang, s, n in rows:
        gone = None if t is None else t.replace("\n", "")
        even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        by_source[s].append(((i is not None, i or 0), leaf([i, s, lang, n, t]), leaf([i, s, lang, n, gone]) if even else None, i))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_of([x[1] for x in sorted(by_source[s], key=lambda x: x[:2])]) for s in names}
    top = tree_of([trees[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for i, x in enumerate(sorted(by_source[s], key=lambda x: x[:2])):
            path = path_of(trees[s], i) + path_of(top, place)
            end = fold(x[2] or x[1], path)
            out.append((x[3], x[1], trees[s][-1][0], top[-1][0], sha("".join(d for _, o in path for d in o)), end, end == top[-1][0]))
    return sorted(out, key=str)


def got_proofs(docs):
    return sorted((tuple(r) for r in merkle.proofs_of(docs).collect()), key=str)


def test_proofs_on_odd_rows(spark, monkeypatch):
    rows = helpers.odd_rows(n=120) + [(500 + i, f"line\n{i}", "en", "hot") for i in range(100)]
    full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
    docs = helpers.documents(spark, rows)
    want = plain_proofs(full)
    assert {w[-1] for w in want} == {True, False}
    assert got_proofs(docs) == want
    monkeypatch.setattr(merkle, "LEVELS", 2)  # trees of several rounds, with many blocks
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 9)
    monkeypatch.setattr(merkle, "ASKERS", 1)
    assert got_proofs(docs) == want
    assert got_proofs(docs.where("doc_id = 4")) == plain_proofs([x for x in full if x[0] == 4])
    assert merkle.proofs_of(docs.limit(0)).count() == 0


def test_many_sources_and_some_leaves(spark, monkeypatch):
    """Proofs of a few leaves fetch the nodes beside them, each once; many sources make the upper tree deep."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK_LEAVES", 50)
    rows = [(i, f"t{i}", "en", f"s{i % 40}", 2) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    manifest = merkle.Manifest(docs.select("doc_id", "source", merkle.leaf_of(merkle.FIELDS).alias("leaf")))
    want = {p[0]: p for p in plain_proofs(rows)}
    got = manifest.prove(manifest.leaves.where("doc_id % 37 = 0")).collect()
    assert sorted(r.doc_id for r in got) == list(range(0, 300, 37))
    for r in got:
        assert (r.leaf.hex(), r.top.hex(), r.proof.hex()) == want[r.doc_id][1:3] + (want[r.doc_id][4],)
        assert r.folded == manifest.root


def test_missing_coordinates_are_the_least():
    rng = random.Random(3)
    for n in (1, 2, 3, 4, 9, 10, 28, 81, 100):
        for _ in range(5):
            leaves = rng.sample(range(n), rng.randint(1, n))
            asked = merkle.missing(leaves, n)
            assert len(set(asked)) == len(asked)
            above = {(level, i // 3 ** level) for i in leaves for level in range(merkle.height(n) + 1)}
            need = {(level, k) for i in leaves for level in range(merkle.height(n))
                    for k in range(i // 3 ** (level + 1) * 3, min(i // 3 ** (level + 1) * 3 + 3, merkle.count_at(n, level)))}
            assert set(asked) == need - above


# Secrets


BASE = [("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def base_spans(text):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p, g, least) in enumerate(BASE) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


SECRETS = ["password = 'abcdef'", "API_KEY:abc", "secret:token:abcdefgh", "token=passw token=abcdefg", "ſecret=abcdef", "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 12, "AKIA" + "C" * 15,
           "0123456789abcdef" * 2, "deadbeef" * 2, "é" * 30 + "apikey=====" + "f" * 24, "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a1" * 18, "://user:secret99@host.org",
           "xoxb-" + "1" * 24, "eyJ" + "a" * 10 + ".eyJ" + "b" * 10 + "." + "c" * 20, "to\x00ken= abcdef", "toKen:\n abcdef"]


def secret_rows():
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(SECRETS + ["the", "word", "𝔘"]) for _ in range(rng.randint(1, 30))), "en", "a") for i in range(80)]
    return rows + rows[:10] + [(200, rows[3][1], None, None), (None, rows[3][1], None, None), (None, None, None, None), (201, "", None, None), (202, ("x " * 40000) + SECRETS[5], None, None)]


def scanned(frame):
    return sorted((str(r.path), [f"{s.kind}:{s.start}:{s.end}" for s in r.spans]) for r in frame.collect())


def test_secrets_on_odd_rows(spark):
    rows = secret_rows()
    docs = helpers.documents(spark, rows)
    got = scanned(secrets.scan_documents(docs))
    assert [(p, [s for s in found if s.split(":")[0] in ("assign", "access", "hex")]) for p, found in got] == sorted((str(i), base_spans(t)) for i, t, *_ in rows)
    kinds = {s.split(":")[0] for _, found in got for s in found}
    assert kinds == {r.kind for r in secrets.RULES}
    assert secrets.scan_documents(docs.limit(0)).count() == 0


def test_only_unseen_pairs_are_scanned(spark):
    rows = secret_rows()
    docs = helpers.documents(spark, rows)
    folder = fresh_path(spark, "ledger-test")
    ledger = secrets.BlobLedger(spark, folder)
    first, rest = docs.where("doc_id % 2 = 0"), docs
    blobs = lambda d: {r.blob for r in secrets.versions_of(d).select("blob").distinct().collect()}
    done = {r.blob: r.rules for r in ledger.record(secrets.versions_of(first), secrets.BASE).collect()}
    assert set(done) == blobs(first) and all(len(r) == 3 for r in done.values())
    done = {r.blob: r.rules for r in ledger.record(secrets.versions_of(rest), secrets.BASE).collect()}
    assert set(done) == blobs(rest) - blobs(first)
    assert ledger.record(secrets.versions_of(rest), secrets.BASE).count() == 0
    stricter = [secrets.Rule("hex", 2, "[0-9a-f]{30,}")]
    done = {r.blob: r.rules for r in ledger.record(secrets.versions_of(rest), secrets.BASE[:2] + stricter).collect()}
    assert set(done) == blobs(rest) and all(r == ["hex@2"] for r in done.values())
    assert ledger.scans().count() == ledger.scans().distinct().count() == 4 * len(blobs(rest))
    # findings reach all paths, of the rule versions that are asked for
    assert scanned(secrets.scan_documents(rest, folder, secrets.BASE)) == sorted((str(i), base_spans(t)) for i, t, *_ in rows)
    newer = ledger.findings(stricter).select(F.explode("spans").alias("s")).select("s.*").collect()
    assert newer and all(s["end"] - s["start"] >= 30 for s in newer)


def test_findings_without_their_scan_do_not_count(spark):
    """A delivery that died between its two writes."""
    folder = fresh_path(spark, "ledger-test")
    ledger = secrets.BlobLedger(spark, folder)
    spark.createDataFrame([("b", "hex@1", "hex", 1, 30)], ledger.FINDINGS).write.parquet(f"{folder}/findings")
    assert ledger.scans().count() == 0
    spark.createDataFrame([("c", "hex@1")], ledger.SCANS).write.parquet(f"{folder}/scans")
    assert ledger.findings().count() == 0
