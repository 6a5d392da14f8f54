"""The pipeline against its stages done plainly on one machine, and the registration of all queries."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import langid, mixing, pieces
from tests.llm import helpers
from tests.conftest import SF


def plain_until_mix(spark, docs):
    """Rows (doc_id, text, lang, source) after the first three stages."""
    frame = helpers.documents(spark, docs)
    model = langid.fit(frame.where(~langid.held_out(F.col("doc_id"))))
    rows = [r for r in docs if not model.predict(r[1])[2]]
    roots = helpers.components([helpers.simhash(r[1]) for r in rows])
    best = {}
    for r, root in zip(rows, roots):
        key = (r[0] is None, r[0] or 0)
        if root not in best or key < best[root][0]:
            best[root] = (key, r)
    rows = [r for _, r in best.values()]
    return [(i, k.decode("utf-8", "ignore"), lang, s) for (i, _, lang, s), (k, _, _) in zip(rows, helpers.repeats([r[:2] for r in rows]))]


@pytest.mark.parametrize("odd", [True, False])
def test_pipeline_against_plain_stages(spark, odd, tmp_path):
    if odd:
        docs = [r for r in helpers.odd_rows() if r[0] is not None] + [(None, "one without an id here", "en", "a")]
    else:
        docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    frame = helpers.documents(spark, docs).select("doc_id", "text", "lang", "source", "n_chars")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    left = plain_until_mix(spark, docs)
    mixed = mixing.mix_documents(helpers.documents(spark, left).select("doc_id", "text", "lang", "source", "n_chars")).collect()
    model = pieces.model(__import__("public_tokenizers").path("piece_bpe_32k.model"))
    want = sorted((str(r.doc_id), helpers.sha(model.encode_bytes(r.text)), helpers.sha(model.decode(model.encode(r.text)).encode())) for r in mixed)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.ids_sha256, r.decoded_sha256) for r in got) == want and want
    sizes, taken = {}, {}
    for i, t, _, s in left:
        sizes[s] = sizes.get(s, 0) + len(helpers.WORD.findall(t))
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + len(helpers.WORD.findall(r.text))
    whole = {(str(i), t) for i, t, _, _ in left}
    assert all((str(r.doc_id), r.text) in whole for r in mixed)
    largest = {s: max(len(helpers.WORD.findall(t)) for _, t, _, x in left if x == s) for s in sizes}
    assert all(abs(t - taken.get(s, 0)) <= largest[s] / 2 + 1 for s, t in helpers.targets(sizes).items())


def test_every_stage_takes_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0


def test_all_queries_and_the_pipeline_are_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14)) and "pipeline" in names
    assert np.all([n in names for n in entry.oracle_sql()])
