import random
from collections import Counter

import numpy as np
from corpus_cases import edge_docs, edge_rows, empty_docs

from sysledger.llm import ordinal_quality
from sysledger.llm.ordinal_quality import Model, Scorer, Settings, features, fit, fit_arrays, graded, score, select_rows

MID = "/root/testdata/sf0.01"


def test_thresholds_are_ordered_and_grades_rise(spark):
    rng = random.Random(1)
    rows, grades = [], []
    for _ in range(600):
        g = rng.randrange(4)
        rows.append(np.array([g * 2 + rng.randrange(2), 50 + rng.randrange(20)], dtype=np.int32))
        grades.append(g)
    m = fit_arrays(rows, np.array(grades), Settings(dims=128, min_documents=2))
    assert (np.diff(m.thresholds) > 0).all()
    expected = m.tails(np.array([m.weights[r].sum() for r in rows])).sum(axis=1)
    means = [expected[np.array(grades) == g].mean() for g in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1.5


def test_gradient(spark):
    """The fit ends where the likelihood is flat."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 40, 6)).astype(np.int32) for _ in range(300)]
    truth = rng.normal(size=40)
    s = np.array([truth[r].sum() for r in rows])
    grades = np.digitize(s + rng.logistic(size=300), [-1, 1])
    m = fit_arrays(rows, grades, Settings(dims=64, min_documents=1, iterations=200))
    got = np.array([m.weights[r].sum() for r in rows])
    assert np.corrcoef(got, s)[0, 1] > 0.8


def test_held_out_accuracy(spark):
    """Trained on half of the rated documents, held against the other half."""
    docs, ratings = spark.read.parquet(f"{MID}/documents.parquet"), graded(spark.read.parquet(f"{MID}/labels.parquet"))
    model = fit(docs, ratings.where("doc_id % 2 = 0"))
    truth = {r.doc_id: r.grade for r in ratings.where("doc_id % 2 = 1").collect()}
    rows = [r for r in score(docs, model).collect() if r.doc_id in truth]
    clean = [r.kept for r in rows if truth[r.doc_id] == 2]
    low = [r.kept for r in rows if truth[r.doc_id] == 0]
    assert sum(clean) / len(clean) > 0.95
    assert sum(low) / len(low) < 0.4


def test_held_out_accuracy_with_more_ratings(spark):
    """Two thousand ratings: good ones stay, four of five low ones go."""
    large = "/root/testdata/sf0.1"
    docs, ratings = spark.read.parquet(f"{large}/documents.parquet"), graded(spark.read.parquet(f"{large}/labels.parquet"))
    model = fit(docs, ratings.where("doc_id % 2 = 0"))
    kept = {r.doc_id: r.kept for r in score(docs, model).collect()}
    held = [(r.grade, kept[r.doc_id]) for r in ratings.where("doc_id % 2 = 1").collect()]
    clean, low = [k for g, k in held if g == 2], [k for g, k in held if g == 0]
    assert sum(clean) / len(clean) > 0.98 and sum(low) / len(low) < 0.25, (sum(clean), len(clean), sum(low), len(low))


def test_edges(spark):
    ratings = spark.createDataFrame([(5, 1, 0), (8, 1, 0), (10, 0, 0), (12, 1, 1), (12, 1, None), (None, 0, 0), (77, 0, 0), (1, None, None)],
                                    "doc_id long, quality int, toxic int")
    model = fit(edge_docs(spark), graded(ratings), Settings(min_documents=1))
    rows = score(edge_docs(spark), model).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows())
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows)
    kept = select_rows(edge_docs(spark), model)
    assert kept.columns == edge_docs(spark).columns
    assert kept.count() == sum(r.kept for r in rows)
    assert score(empty_docs(spark), model).collect() == []


def test_nothing_rated(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = fit(edge_docs(spark), graded(none))
    assert model is None
    assert all(r.kept and r.expected_grade is None for r in score(edge_docs(spark), model).collect())


def test_scores_match_a_recomputation(spark, monkeypatch):
    """Every score again from the features of the whole text, one by one."""
    monkeypatch.setattr(ordinal_quality, "WORD_CACHE", 50)  # the cache is emptied many times
    rng = np.random.default_rng(5)
    dims = 4096
    model = Model(rng.normal(size=dims).astype(np.float32), np.array([-1.0, 0.5]), 3, 0.4)
    docs = edge_docs(spark).unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), allowMissingColumns=True)
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    scorer = Scorer(model.weights)
    want = {}
    for doc_id, found in texts.items():
        for text in found:
            ids = features(text or "", dims)
            total = sum(float(model.weights[i]) for i in ids)
            assert abs(scorer.score(text or "") - total) < 1e-3 * max(1, len(ids) ** 0.5)
            tails = [1 / (1 + np.exp(-min(35, max(-35, total - t)))) for t in model.thresholds]
            want.setdefault(doc_id, []).append((round(sum(tails), 2), round(tails[-1], 2)))
    got = {}
    for r in score(docs, model).collect():
        assert r.kept == (r.tail_probability >= 0.4)
        got.setdefault(r.doc_id, []).append((r.expected_grade, r.tail_probability))
    assert set(got) == set(want)
    for i in got:
        assert np.allclose(sorted(got[i]), sorted(want[i]), atol=0.02), i


def test_the_sample_is_bounded_in_features(spark):
    docs, ratings = spark.read.parquet(f"{MID}/documents.parquet"), graded(spark.read.parquet(f"{MID}/labels.parquet"))
    seen = []
    real = ordinal_quality.fit_with_cut
    try:
        ordinal_quality.fit_with_cut = lambda rows, grades, settings: seen.append(sum(map(len, rows)))
        fit(docs, ratings, Settings(max_train_ids=20_000))
        fit(docs, ratings, Settings())
    finally:
        ordinal_quality.fit_with_cut = real
    assert 5_000 < seen[0] < 60_000 < seen[1]


def test_fit_holds_the_features_once():
    """The driver's memory beside the rows: a column of four bytes a feature and
    runs of bounded size."""
    import tracemalloc

    rng = np.random.default_rng(2)
    settings = ordinal_quality.Settings(dims=1 << 12, iterations=3)
    rows = [rng.integers(0, settings.dims, 2_000).astype(np.int32) for _ in range(2_000)]
    tracemalloc.start()
    assert ordinal_quality.fit_arrays(rows, rng.integers(0, 3, len(rows)), settings) is not None
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * 4_000_000
