import random

from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm.packing import pack_documents
from tallyhouse.llm.quality import fit_quality, quality_scores
from tallyhouse.llm.queries import tokenizer_path

from .test_minhash import brute
from .test_packing import check

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, folder):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [prose(rng.randint(20, 120)) for _ in range(60)]
    texts += [t + " end" for t in texts[10:20]] + [texts[3]] * 5
    passage = prose(80)
    texts += [f"{prose(60)} {passage} {prose(60)}" for _ in range(6)]
    texts += ["WIN!! $$$ ### %%% CASH!! " * rng.randint(3, 30) + word() for _ in range(40)]
    rows = [(k, t, "en", f"s{k % 4}", len(t)) for k, t in enumerate(texts)]
    rows += [(1000, None, None, None, None), (1001, "", "en", "s1", 0), (1002, " \n", "en", None, 2)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, int(not t.startswith("WIN"))) for k, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    return {r[0]: r[1] for r in rows}, passage


def test_stages_one_after_the_other(spark, tmp_path):
    texts, passage = corpus(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "passages", "mix", "packing"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        out[name] = docs
        if name != "packing":
            assert docs.dtypes == before.dtypes

    kept = {r.doc_id: r.text for r in out["quality"].collect()}
    model = fit_quality(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    scores = quality_scores(spark.read.parquet(f"{tmp_path}/documents.parquet"), model).collect()
    assert kept.keys() == {r.doc_id for r in scores if r.score >= 0.7}
    assert not any(t and t.startswith("WIN") for t in kept.values())
    assert all(k in kept for k, t in texts.items() if t and t.strip() and not t.startswith("WIN"))

    firsts = {i for i, (_, _, first) in brute(list(kept.items()), 5).items() if first}
    deduped = {r.doc_id: r.text for r in out["near_dedup"].collect()}
    assert deduped == {i: t for i, t in kept.items() if i in firsts} and len(deduped) < len(kept)

    cut = out["passages"].collect()
    assert {r.doc_id for r in cut} == deduped.keys()
    assert sum(passage in (r.text or "") for r in cut) == 1
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut)
    clean = [r for r in cut if passage not in (deduped[r.doc_id] or "")]
    assert all(r.text == deduped[r.doc_id] for r in clean)

    mixed = out["mix"].collect()
    counts = {r.doc_id: 0 for r in cut}
    for r in mixed:
        counts[r.doc_id] += 1
    assert set(counts.values()) <= {0, 1, 2} and len(mixed) > len(cut)
    words = lambda rows: sum(len((r.text or "").split()) for r in rows)
    assert abs(words(mixed) - 1.5 * words(cut)) < 0.1 * words(cut)

    numbered = {k: r.text for k, r in enumerate(mixed)}
    pieces = pack_documents(spark.createDataFrame(list(numbered.items()), "doc_id long, text string"), tokenizer_path()).collect()
    assert check(pieces, numbered, 2048) == 0
    packed = out["packing"].collect()
    assert sum(p.length for p in packed) == sum(p.length for p in pieces)


def test_run_returns_the_last_stage(spark, tmp_path):
    corpus(spark, tmp_path)
    assert "sequence_id" in corpus_pipeline.run(spark, str(tmp_path)).columns
    empty = tmp_path / "empty"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0


def test_repeated_rows_and_rows_without_an_id(spark, tmp_path):
    rng = random.Random(11)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghiklmnoprstu") for _ in range(rng.randint(2, 8))) for _ in range(n))
    one, two, passage = prose(60), prose(60), prose(80)
    texts = [(1, one)] * 4 + [(None, one)] * 2 + [(None, two)] * 5 + [(7, f"{prose(50)} {passage}"), (None, f"{prose(50)} {passage}")]
    texts += [(None if k % 3 == 0 else k, prose(50)) for k in range(100, 500)]
    rows = [(i, t, "en", f"s{k % 4}", len(t)) for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA)

    corpus_pipeline.near_dedup(spark, docs, "").write.parquet(f"{tmp_path}/deduped")
    deduped = spark.read.parquet(f"{tmp_path}/deduped")
    found = [(r.doc_id, r.text) for r in deduped.collect()]
    assert sorted(found, key=str) == sorted(set(texts) - {(None, one)}, key=str)

    corpus_pipeline.passages(spark, deduped, "").write.parquet(f"{tmp_path}/cut")
    cut = spark.read.parquet(f"{tmp_path}/cut")
    kept = [r.doc_id for r in cut.collect() if passage in r.text]
    assert kept in ([7], [None])  # the row that lies first

    words = lambda rows: sum(len(r.text.split()) for r in rows)
    mixed = corpus_pipeline.mix(spark, cut, "").collect()
    assert {r.doc_id is None for r in mixed} == {True, False}
    assert abs(words(mixed) - 1.5 * words(cut.collect())) < 0.05 * words(cut.collect())


def test_columns_of_any_name_go_through_every_stage(spark, tmp_path):
    """Names that the operators use themselves come back with what they held."""
    corpus(spark, tmp_path)
    names = ["score", "predicted", "removed", "_cut", "_own_id", "own_id", "_copies", "copies", "_place", "file_name", "row_index", "extra_7", "a.b"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    docs = docs.select("*", *[F.concat_ws("/", F.lit(name), "doc_id").alias(name) for name in names])
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before = docs
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/extra-{name}")
        docs = spark.read.parquet(f"{tmp_path}/extra-{name}")
        assert docs.dtypes == before.dtypes
        for row in docs.collect():
            assert [row[c] for c in names] == [f"{c}/{row.doc_id}" if row.doc_id is not None else c for c in names]
    assert docs.count() > 20


def test_rows_are_numbered_in_place(spark, tmp_path):
    """Numbers are distinct, follow the files and are the same each time."""
    spark.range(0, 5000, 1, 7).selectExpr("id % 10 AS doc_id", "cast(id AS string) AS text").write.parquet(f"{tmp_path}/rows")
    docs = spark.read.parquet(f"{tmp_path}/rows")
    found = [sorted((r.doc_id, int(r.text), r.own_id) for r in corpus_pipeline._keyed(spark, docs).collect()) for _ in range(2)]
    assert found[0] == found[1] and len({number for number, _, _ in found[0]}) == 5000
    assert [text for _, text, _ in found[0]] == list(range(5000)) and all(own == text % 10 for _, text, own in found[0])
