import importlib.util
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import quality as Q
from kestrel.llm.common import store, table
from kestrel.llm.quality import curve, filter_quality, fit_quality, op1_quality_classifier, score_quality
from tests.llm import brute


def test_held_out_accuracy(spark, mid_dir):
    docs, labels = table(spark, mid_dir, "documents"), table(spark, mid_dir, "labels")
    hidden = labels.where("doc_id % 3 = 0")
    model = fit_quality(docs, labels.where("doc_id % 3 <> 0"))
    rows = score_quality(docs, model).join(hidden, "doc_id").collect()
    assert len(rows) > 100 and np.mean([r["keep"] == (r["quality"] == 1) for r in rows]) >= 0.97
    good = [r for r in rows if r["quality"] == 1]
    assert np.mean([r["keep"] for r in good]) >= 0.98


def test_query_scores_every_document_alike(spark, small_dir):
    a = {r["doc_id"]: r for r in op1_quality_classifier(spark, small_dir).collect()}
    assert len(a) == table(spark, small_dir, "documents").count()
    b = {r["doc_id"]: r for r in op1_quality_classifier(spark, small_dir).collect()}
    assert a == b and all(0 <= r[c] <= 1 for r in a.values() for c in ("p_text", "p_meta", "score"))


def two_classes(spark, n, labelled):
    """Documents whose words and, nine times in ten, whose source tell their class; a few are labelled."""
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 2, n)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 50, 20) + 50 * int(t)), "en", str(int(t if rng.random() < 0.9 else 1 - t)), 100)
            for i, t in enumerate(truth)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, int(truth[i])) for i in range(labelled)], "doc_id long, quality int")
    return docs, labels, truth


def test_views_teach_each_other(spark):
    docs, labels, truth = two_classes(spark, 600, 40)
    rows = score_quality(docs, fit_quality(docs, labels, sure=0.8)).collect()
    assert np.mean([(r["score"] >= 0.5) == (truth[r["doc_id"]] > 0) for r in rows]) > 0.97
    assert np.mean([(r["p_meta"] >= 0.5) == (truth[r["doc_id"]] > 0) for r in rows]) > 0.85
    w = curve(np.array([[-2.0], [-1.0], [1.0], [2.0]] * 20), np.array([0, 0, 1, 1] * 20))
    assert w[0] > 0 and abs(w[1]) < 0.3


def test_the_whole_pool_is_scored_and_taught(spark, monkeypatch):
    """Histograms hold every document outside the sample, and the sums equal those of plain loops over the confident ones."""
    docs, labels, _ = two_classes(spark, 600, 60)
    seen, kept = [], (Q.pool_counts, Q.pool_pulls)
    monkeypatch.setattr(Q, "pool_counts", lambda *a: seen.append([kept[0](*a)]) or seen[-1][0])
    monkeypatch.setattr(Q, "pool_pulls", lambda *a: seen[-1].extend([a, kept[1](*a)]) or seen[-1][2])
    fit_quality(docs, labels, labelled=30, rounds=2, sure=0.7)
    monkeypatch.undo()
    assert len(seen) == 2
    for counts, (_, known, models, curves, cuts, trust), pulls in seen:
        assert len(known) == 30 and counts.sum(1).tolist() == [570, 570]
        views = Q.feature_views(Q.features(docs).where(~F.col("doc_id").isin(known.tolist())).toArrow().combine_chunks())
        for k in range(2):
            odds = models[1 - k].score(views[1 - k]) * curves[1 - k][0] + curves[1 - k][1]
            total = 0
            for side, on in enumerate((Q.bins(odds) <= cuts[1 - k][0], Q.bins(odds) >= cuts[1 - k][1])):
                rows = np.flatnonzero(on)
                assert 0 < len(rows) < 570
                v = views[k].take(rows)
                total += trust / 2 / len(rows) * models[k].sums(v, Q.sigmoid(models[k].score(v)) - side, np.ones(len(rows)))[0]
            assert np.allclose(pulls[k].gradient, total, atol=1e-5)


def test_pull_never_overshoots():
    """The bound lies above the pool's logistic loss wherever the model goes."""
    rng = np.random.default_rng(1)
    v = Q.View(rng.integers(0, 16, 200).astype(np.int32), np.arange(41) * 5, np.full(40, 0.7), rng.normal(size=(40, 2)), 16)
    model = Q.Linear(rng.normal(size=19), np.zeros(2), np.ones(2))
    y = rng.integers(0, 2, 40)
    g, h = model.sums(v, Q.sigmoid(model.score(v)) - y, np.ones(40))
    loss = lambda m: np.log1p(np.exp(np.where(y, -1, 1) * m.score(v))).sum()
    for _ in range(50):
        d = rng.normal(size=19) * rng.choice([0.1, 1, 5])
        assert loss(Q.Linear(model.theta + d, model.mean, model.dev)) <= loss(model) + g @ d + (h * d * d).sum() / 2 + 1e-9


def test_quality_edges(spark, edge, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 0), (6, None), (None, 0), (11, 0), (4, 0), (9, 1)], "doc_id long, quality int")
    model = fit_quality(edge, labels)
    rows = score_quality(edge, model).collect()
    assert len(rows) == edge.count() and all(r["score"] is not None for r in rows)
    none = labels.where("quality = 1")
    assert fit_quality(edge, none) is None
    assert filter_quality(edge, none).count() == edge.count() and filter_quality(edge, labels).columns == edge.columns
    assert score_quality(empty, model).count() == 0 and fit_quality(empty, labels) is None


needs_pipeline = pytest.mark.skipif(importlib.util.find_spec("corpus_pipeline") is None, reason="no pipeline")


@needs_pipeline
def test_pipeline_stage_by_stage(spark, mid_dir):
    """Each stage against a plain form of it, on what the stage before kept."""
    import corpus_pipeline as P

    docs = table(spark, mid_dir, "documents")
    columns = docs.columns
    kept = {}
    for name, stage in P.STAGES:
        docs = store(stage(spark, docs, mid_dir), "test")
        kept[name] = docs.collect()
        if name != P.STAGES[-1][0]:
            assert docs.columns == columns
    names = [n for n, _ in P.STAGES]
    source = {r["doc_id"]: r["text"] for r in table(spark, mid_dir, "documents").collect()}
    good, cut, single, mixed, packed = (kept[n] for n in names)
    assert all(source[r["doc_id"]] == r["text"] for r in good) and 0.7 * len(source) < len(good) < len(source)
    assert sorted(r["doc_id"] for r in cut) == sorted(r["doc_id"] for r in good)
    key = lambda line: line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(brute.AZ)
    count = Counter(k for r in good for k in {key(x) for x in r["text"].split("\n")} - {""})
    assert {r["doc_id"]: r["text"] for r in cut} == {
        r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if count[key(x)] < 10) for r in good}
    assert all(r["n_chars"] == len(r["text"]) for r in cut)
    comp = brute.near([(r["doc_id"], r["text"]) for r in cut], 5)
    assert sorted(r["doc_id"] for r in single) == sorted(i for i, (_, c) in comp.items() if i == c)
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(copies) <= {r["doc_id"] for r in single} and max(copies.values()) <= 3
    assert len({(r["doc_id"], r["text"]) for r in mixed}) == len(copies)
    tokens = Counter()
    for r in packed:
        tokens[r["doc_id"]] += r["length"]
    assert all(tokens[i] == copies[i] * next(r["doc_tokens"] for r in packed if r["doc_id"] == i) for i in copies)


@needs_pipeline
def test_run_equals_stages(spark, small_dir):
    import corpus_pipeline as P

    got = P.run(spark, small_dir)
    assert got.count() > 0 and got.where(F.col("offset") + F.col("length") > 2048).count() == 0


@needs_pipeline
def test_pipeline_on_awkward_rows_and_empty_tables(spark, edge, empty, small_dir):
    """The chain on nulls, blanks, ties, repeated rows and clashing columns, and on no rows at all."""
    import corpus_pipeline as P

    for docs in (edge, empty):
        columns, rows = docs.columns, docs.count()
        for name, stage in P.STAGES:
            docs = store(stage(spark, docs, small_dir), name)
            if name == "mix_sources":
                assert docs.groupBy(*columns).count().where("count > 3 * 2").count() == 0  # two rows of the table are equal
            if name != P.STAGES[-1][0]:
                assert docs.columns == columns
        assert (docs.count() > 0) == (rows > 0)


def test_mix_never_passes_its_epochs(spark):
    from kestrel.llm.mixing import mix

    rows = [(i, "" if i % 2 else "two words", "a") for i in range(200)] + [(1000 + i, "one two three four " * 30, "b") for i in range(200)]
    rows += [(2000, "", "empty"), (2001, None, "empty")]
    out = Counter(r["doc_id"] for r in mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), max_epochs=3).collect())
    assert max(out.values()) == 3 and out[2000] == out[2001] == 1


def test_other_texts_of_a_kept_doc_id_stay(spark):
    from kestrel.llm.minhash import deduplicate

    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    docs = spark.createDataFrame([(1, a, "x"), (1, a, "x"), (1, b, "y"), (2, a, "z")], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["text"]) for r in deduplicate(docs, words=5).collect()) == [(1, a), (1, b)]


def test_entry_lists_the_queries():
    import __spark_entry__ as E

    q = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in q) for i in range(1, 14)] == [1] * 13
    assert set(E.oracle_sql()) <= set(q)
