"""Every stage of the pipeline against a plain version on its own input; the entry with and without the subpackage."""

import hashlib

import pytest
import public_tokenizers as P
from check_oracle import connect
from test_bpe import LIBRARY
from test_line_dedup import plain as plain_lines
from test_near_dedup import plain_components

import corpus_pipeline
from latewatch.llm import decontaminate, quality
from latewatch.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, sf):
    """What goes into each stage and what comes out."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, sf), "stage")
        out[name] = (before, docs)
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns(stages):
    names = list(stages)
    assert names == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "bpe"]
    assert all(stages[n][1].columns == COLUMNS for n in names[:-1])
    assert P.path("x") and corpus_pipeline.ORACLE_SQL is None


def test_quality(spark, sf, stages):
    before, after = stages["quality_classifier"]
    good = {r.doc_id for r in quality.classify(before, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    assert texts(after) == [(i, t) for i, t in texts(before) if i in good] and 0 < after.count() < before.count()


def test_lines(stages):
    before, after = stages["line_dedup"]
    assert dict(texts(after)) == plain_lines(texts(before))
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_near(stages):
    before, after = stages["near_dedup"]
    rows = texts(before)
    top = plain_components(rows, 5)
    assert texts(after) == [(i, t) for i, t in rows if top[i][0] == i]


def test_leaks(spark, sf, stages):
    before, after = stages["decontamination"]
    con = connect(sf)
    frame = before.toPandas()
    con.register("frame", frame)
    con.execute("DROP VIEW documents")
    con.execute("CREATE VIEW documents AS SELECT * FROM frame")
    bad = {r[0] for r in con.execute(decontaminate.SQL).fetchall()}
    assert texts(after) == [(i, t) for i, t in texts(before) if i not in bad] and bad


def test_encoding(stages):
    before, after = stages["bpe"]
    want = dict(texts(before))
    rows = after.collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r.n_tokens == len(LIBRARY.encode_ordinary(want[r.doc_id])) and r.decoded_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages(spark, sf, stages):
    key = lambda df: sorted((r.doc_id, r.decoded_sha256) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf)) == key(stages["bpe"][1])


def test_empty_documents(spark, sf, tmp_path):
    docs = spark.createDataFrame([], spark.read.parquet(f"{sf}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf), "empty")
    assert docs.count() == 0
