"""Quality classifier: trees against plain ones, held-out accuracy, odd rows."""

import numpy as np

from latewatch.llm import quality as Q


def walk(model, row):
    total = model.start
    for feature, cut, value in zip(model.feature, model.cut, model.value):
        node = 0
        while node < len(feature):
            node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
        total += value[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def test_traversal_and_fit():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] > 0)).astype(float)
    model = Q.fit(x[:1000], y[:1000], trees=30)
    p = model.score(x[1000:])
    assert np.allclose(p, [walk(model, r) for r in x[1000:]])
    assert ((p > 0.5) == y[1000:]).mean() > 0.95


def test_fit_without_rows_or_with_one_class():
    assert np.allclose(Q.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))), 0.5)
    assert (Q.fit(np.zeros((9, 3)), np.ones(9)).score(np.zeros((2, 3))) > 0.9).all()


def test_statistics_of_odd_texts():
    for t in (None, "", " ", "\n\n", "a", "\U0001f600" * 10, "x" * 200_000, "a " * 100_000):
        assert np.isfinite(Q.statistics(t)).all()
    names = dict(zip(Q.STATISTICS, Q.statistics("AB ab\nAB ab\n12 |!")))
    assert abs(names["duplicate_lines"] - 1 / 3) < 1e-6 and abs(names["upper"] - 4 / 17) < 1e-6


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = Q.classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet").withColumnRenamed("doc_id", "id")
    rows = out.where("held_out").join(labels, out.doc_id == labels.id).collect()
    assert len(rows) > 40 and np.mean([r.predicted == r.quality for r in rows]) > 0.9
    kept = Q.keep_good(spark.read.parquet(f"{sf}/documents.parquet"), labels.withColumnRenamed("id", "doc_id"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in out.where("predicted = 1").select("doc_id").collect())


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int")
    rows = Q.classify(docs, labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert Q.classify(docs.limit(0), labels).count() == 0
    assert Q.classify(docs, labels.limit(0)).select("predicted").distinct().collect()[0][0] == 1
