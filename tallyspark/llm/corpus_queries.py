"""Queries of spelling variants, the dataset manifest and secret scans."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import merkle, secrets, spelling
from .registry import query, table

#: CRC-32 (reflected polynomial 0xEDB88320) of a blob column, bit by bit into a table, then byte by byte.
CRC_TABLE = "SELECT [list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) FOR b IN range(256)] AS tab"


def crc(blob: str) -> str:
    return (f"xor(list_reduce(range(octet_length({blob})), lambda c, i: xor(c >> 8, tab[(xor(c, ('0x' || substr(hex({blob}), (2 * i + 1)::INTEGER, 2))::BIGINT) & 255) + 1]), "
            "4294967295), 4294967295)")


OP11 = rf"""
WITH RECURSIVE t AS ({CRC_TABLE}),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS c, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS b FROM r WHERE length(run) >= 5 GROUP BY doc_id, run),
h AS (SELECT run, c, {crc('b')} AS h FROM d, t),
s AS (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run))::INTEGER + 2) ELSE run END AS word, c FROM h),
w AS (SELECT word, sum(c)::BIGINT AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
x AS (SELECT word, n, unnest(range(length(word))) AS p FROM w),
g AS (SELECT word, n, p, substr(word, 1, p::INTEGER) || substr(word, p::INTEGER + 2) AS rest FROM x),
e AS (SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM g a JOIN g b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM g a JOIN w b ON a.rest = b.word UNION SELECT b.word, b.n, a.word, a.n FROM g a JOIN w b ON a.rest = b.word),
k AS (SELECT word, n, count(*) AS n_near, min(struct_pack(a := -near_n, b := near)) AS best FROM e GROUP BY word, n),
f AS (SELECT w.word, w.n, coalesce(k.n_near, 0) AS n_near, CASE WHEN -k.best.a >= 2 * w.n THEN k.best.b END AS form,
  CASE WHEN -k.best.a >= 2 * w.n THEN -k.best.a END AS form_n FROM w LEFT JOIN k ON w.word = k.word),
q AS (SELECT word, form AS at FROM f WHERE form IS NOT NULL UNION ALL SELECT q.word, f.form FROM q JOIN f ON q.at = f.word WHERE f.form IS NOT NULL),
z AS (SELECT q.word, q.at FROM q JOIN f ON q.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(z.at, f.word) AS root, f.n, f.n_near, f.form_n FROM f LEFT JOIN z ON f.word = z.word"""


def _leaf(text: str) -> str:
    field = lambda c: f"coalesce(octet_length(encode({c})) || ':' || {c}, '-')"
    return "sha256(" + " || ".join(field(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"


OP12 = rf"""
WITH RECURSIVE t AS ({CRC_TABLE}),
d AS (SELECT doc_id, source, {_leaf('text')} AS leaf, {_leaf("replace(text, chr(10), '')")} AS gone,
  coalesce({crc('encode(doc_id::VARCHAR)')} % 2 = 0, false) AS even FROM documents, t),
s AS (SELECT source, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, n, count(*) OVER () AS sources FROM (SELECT source, count(*) AS n FROM d GROUP BY source)),
l AS (SELECT d.*, s.tree, s.n, s.sources, row_number() OVER (PARTITION BY s.tree ORDER BY d.doc_id NULLS FIRST, d.leaf) - 1 AS idx, row_number() OVER () AS id
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
nodes AS (SELECT tree, n, 0 AS level, idx, leaf AS digest FROM l
  UNION ALL SELECT tree, max((n + 2) // 3), max(level) + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, idx // 3),
sub AS (SELECT tree, digest FROM nodes WHERE n = 1),
tops AS (SELECT (SELECT count(*) FROM sub) AS n, 0 AS level, tree AS idx, digest FROM sub
  UNION ALL SELECT max((n + 2) // 3), max(level) + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY idx // 3),
allnodes AS (SELECT tree, n, level, idx, digest FROM nodes UNION ALL SELECT -1, n, level, idx, digest FROM tops),
steps AS (SELECT DISTINCT tree, level FROM nodes WHERE n > 1),
height AS (SELECT tree, count(*) AS h FROM steps GROUP BY tree),
p AS (SELECT l.id, steps.level AS step, l.tree, steps.level, l.idx // (3 ** steps.level)::BIGINT AS at FROM l JOIN steps ON l.tree = steps.tree
  UNION ALL SELECT l.id, coalesce(height.h, 0) + u.level, -1, u.level, l.tree // (3 ** u.level)::BIGINT
  FROM l LEFT JOIN height ON l.tree = height.tree JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) u ON true),
b AS (SELECT p.id, p.step, coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (WHERE o.idx < p.at), '') AS lefts,
  coalesce(string_agg(o.digest, '' ORDER BY o.idx) FILTER (WHERE o.idx > p.at), '') AS rights
  FROM p JOIN allnodes o ON o.tree = p.tree AND o.level = p.level AND o.idx // 3 = p.at // 3 GROUP BY p.id, p.step),
proof AS (SELECT id, sha256(string_agg(lefts || rights, '' ORDER BY step)) AS proof_sha256 FROM b GROUP BY id),
fold AS (SELECT id, 0 AS step, CASE WHEN even THEN gone ELSE leaf END AS digest FROM l
  UNION ALL SELECT fold.id, fold.step + 1, sha256(b.lefts || fold.digest || b.rights) FROM fold JOIN b ON fold.id = b.id AND fold.step = b.step),
done AS (SELECT id, max_by(digest, step) AS folded_root FROM fold GROUP BY id),
root AS (SELECT digest FROM tops WHERE n = 1)
SELECT l.doc_id, l.leaf, sub.digest AS subroot, root.digest AS root, coalesce(proof.proof_sha256, sha256('')) AS proof_sha256, done.folded_root,
  done.folded_root = root.digest AS verified
FROM l JOIN sub ON l.tree = sub.tree JOIN done ON l.id = done.id LEFT JOIN proof ON l.id = proof.id, root"""


#: The base kinds in the words of their definition: kind, pattern, group whose length counts, least length.
BASE_KINDS = [
    ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24)]


def _spans(kind: str, pattern: str, group: int, least: int, place: int) -> str:
    """Matches with their places, from the pieces between matches."""
    pattern = pattern.replace("'", "''")
    kept = f"length(regexp_extract(m, '{pattern}', {group}))"
    ahead = "OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""SELECT id, '{kind}' AS kind, {place} AS place, start, start + length(m) AS stop FROM (
  SELECT id, m, (length(piece) + coalesce(sum(length(piece) + length(m)) {ahead}, 0))::BIGINT AS start FROM (
    SELECT id, unnest(matches) AS m, unnest(pieces[1:len(matches)]) AS piece, unnest(range(len(matches))) AS i
    FROM (SELECT id, string_split_regex(text, '{pattern}') AS pieces, regexp_extract_all(text, '{pattern}') AS matches FROM d))) WHERE {kept} >= {least}"""


KINDS = BASE_KINDS + [(r.kind, r.pattern, r.group, r.least) for r in secrets.MARKED]
OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
f AS ({' UNION ALL '.join(_spans(*k, i) for i, k in enumerate(KINDS))}),
g AS (SELECT id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
  coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (WHERE place < {len(secrets.BASE)}), '') AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM f GROUP BY id)
SELECT d.doc_id, coalesce(g.n_assign, 0) AS n_assign, coalesce(g.n_access, 0) AS n_access, coalesce(g.n_hex, 0) AS n_hex,
  sha256(coalesce(g.base, '')) AS base_sha256, coalesce(g.spans, '') AS spans FROM d LEFT JOIN g ON d.id = g.id"""


@query("op11_spelling", OP11)
def op11_spelling(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_merkle", OP12)
def op12_merkle(spark, sf_dir):
    return merkle.proofs_of(table(spark, sf_dir, "documents"))


@query("op13_secrets", OP13)
def op13_secrets(spark, sf_dir):
    found = secrets.scan_documents(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["place"] < len(secrets.BASE))
    return found.select(F.col("path").alias("doc_id"), count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined("spans").alias("spans"))
