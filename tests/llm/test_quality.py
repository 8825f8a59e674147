import zlib

import numpy as np

from tallyhouse.llm.quality import QualityModel, fit_quality, fitted, quality_scores, terms
from tallyhouse.llm.queries import op2_quality_classifier

GOOD = "the river ran past an old mill where children used to play in summer and nobody minded the noise"
BAD = "BUY!! NOW!! $$$ ### %%% win&&& win&&& win&&&"


def test_held_out_accuracy_over_a_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = op2_quality_classifier(spark, sf).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) >= 0.95
    assert np.mean([p for p, y in held if y == 1]) >= 0.98


def test_scores_equal_votes_one_by_one():
    rng = np.random.default_rng(0)
    rows = np.array([terms(GOOD[k:] if k % 2 else BAD[: 20 + k]) for k in range(40)])
    model = fitted(rows, rng.integers(0, 2, 40).astype(float))
    got = model.scores(rows[:10])
    for row, score in zip(model.latent(rows[:10]), got, strict=True):
        sims = model.voters @ row
        near = np.argsort(-sims)[:25]
        weight = np.maximum(sims[near], 0).astype(float) ** 8
        assert abs(score - (weight * model.labels[near]).sum() / weight.sum()) < 0.08  # ties at the last place


def test_edge_cases(spark):
    docs = [(k, GOOD + f" {k}") for k in range(30)] + [(k, BAD * (k % 5 + 1)) for k in range(30, 60)]
    odd = [(100, None), (101, ""), (102, " \n"), (None, GOOD), (103, "x" * 500_000), (104, GOOD), (104, GOOD)]
    df = spark.createDataFrame([(*r, 1.0, "p", "l") for r in docs + odd], "doc_id long, text string, score double, predicted string, label string")
    labels = [(k, int(k < 30), 5) for k in range(60)] + [(None, 1, 0), (5, None, 0), (7, 3, 0), (999, 1, 0), (3, 1, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, text int")
    model = fit_quality(df, labels)
    assert len(model.labels) == 60
    got = quality_scores(df, model)
    assert sorted(got.columns) == sorted(["doc_id", "text", "score", "predicted", "label"])
    rows = got.collect()
    assert len(rows) == len(docs) + len(odd)
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[k].predicted == int(k < 30) for k in range(60)) and by_id[104].predicted == by_id[None].predicted == 1
    assert {by_id[k].score for k in (100, 101, 102)} == {0.5}
    assert quality_scores(df.limit(0), model).count() == 0
    none = fit_quality(df, labels.limit(0))
    assert len(none.voters) == 0 and {r.score for r in quality_scores(df, none).collect()} == {0.5}
    assert len(fit_quality(df, labels, sample=10).labels) == 10
    assert isinstance(none, QualityModel)


def test_an_id_on_many_rows_votes_once(spark):
    """A labelled doc_id on a third of the rows with different texts: one row of it reaches the model, the same one each time."""
    rows = [(k, GOOD + f" {k}") for k in range(30)] + [(k, BAD * (k % 5 + 1)) for k in range(30, 60)]
    rows += [(7, BAD + f" {k}") for k in range(300)] + [(8, None), (8, "")]
    labels = spark.createDataFrame([(k, int(k < 30)) for k in range(60)], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    models = [fit_quality(x, labels) for x in (df, df.repartition(5))]
    assert all(len(model.labels) == len(model.voters) == 60 for model in models)
    assert np.array_equal(models[0].voters, models[1].voters)
    found = {r.doc_id: r.predicted for r in quality_scores(df.where("doc_id NOT IN (7, 8)"), models[0]).collect()}
    assert all(found[k] == int(k < 30) for k in found)
