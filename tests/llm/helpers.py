"""Small inputs with every odd case, and plain versions of the operators to compare with."""

import hashlib
import random
import re

import xxhash

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, taken string, size int, blocks int, fp int, root int, words_here int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) as documents, with extra columns whose names the operators use themselves."""
    full = [(i, t, lang, s, None if t is None else len(t), "x", 1, 2, 3, 4, 5) for i, t, lang, s in rows]
    return spark.createDataFrame(full, DOCS)


def odd_rows(seed=1, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "and", "thing", "über", "été", "a", "señor", "zebra", "night"]
    long = " ".join(rng.choice(words) for _ in range(6000))
    shared = " ".join(rng.choice(words) for _ in range(30))
    rows = [(None, "no id " + shared, "en", "a"), (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", None), (4, long, "en", "a"), (5, long, "en", "b"),
            (6, shared, "fr", "b"), (6, shared, "fr", "b"), (7, "A.", "de", "c"), (8, "12 34 !!", None, "c"), (9, long + " tail", "en", "é"),
            (None, "no id " + shared, "en", "a"), (10, "word", "en", "A")]
    for i in range(11, n):
        body = " ".join(rng.choice(words) for _ in range(rng.randint(1, 120)))
        rows.append((i, f"{body} {shared} {body[:40]}" if i % 3 == 0 else body, rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])))
    rng.shuffle(rows)
    return rows


def simhash(text, n=3):
    words = [w.encode() for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits=3):
    """Smallest member index reachable for each fingerprint, by trying all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def repeats(rows, match=50):
    """(kept bytes, removed, spans) per (doc_id, text), by looking every window up."""
    first, coded = {}, [(i, (t or "").encode()) for i, t in rows]
    place = lambda i: (1, 0) if i is None else (0, i)
    for i, b in coded:
        for j in range(len(b) - match + 1):
            s = b[j:j + match]
            first[s] = min(first.get(s, (2, 0)), place(i))
    out = []
    for i, b in coded:
        gone = bytearray(len(b))
        for j in range(len(b) - match + 1):
            if first[b[j:j + match]] < place(i):
                gone[j:j + match] = b"\1" * match
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((bytes(x for x, y in zip(b, gone) if not y), sum(gone), spans))
    return out


def targets(sizes):
    """Targets by resharing again and again. `sizes`: source -> words."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(full.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        full |= {s: 2.0 * sizes[s] for s in over}


def sha(data):
    return hashlib.sha256(data).hexdigest()
