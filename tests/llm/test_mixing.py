import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.mixing import mix_sources, pivot, source_targets

SCHEMA = "doc_id long, source string, text string"


def shared(sizes, total_share=1.5, most=2.0, weights=(3, 1, 2)):
    """Targets by sharing, capping and sharing the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    cap = {s: most * sizes[s] for s in names}
    target, open_, left = {}, set(names), total_share * sum(sizes.values())
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = cap[s]
            left -= cap[s]
            open_.discard(s)
    return target


def documents(spark, seed=0, n=4000):
    rng = np.random.default_rng(seed)
    names = ["a", "B", "é", None, "z", "tiny", "blank"]
    rows = []
    for k in range(n):
        source = names[rng.choice(len(names), p=[0.35, 0.2, 0.2, 0.1, 0.1, 0.04, 0.01])]
        size = 0 if source == "blank" else int(rng.pareto(1.2) * 10) % 800
        rows.append((k, source, " \t".join(["w"] * size) if size else [None, "", " \n"][k % 3]))
    return spark.createDataFrame(rows, SCHEMA), rows


def test_targets_by_repeated_sharing(spark):
    rng = np.random.default_rng(1)
    for _ in range(8):
        sizes = {f"s{k}": int(rng.integers(0, 1000)) for k in range(rng.integers(1, 9))} | {None: int(rng.integers(1, 300))}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        assert got == pytest.approx(shared(sizes))


def test_mix_meets_targets_and_bounds(spark):
    df, rows = documents(spark)
    found = mix_sources(df).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    sizes = {}
    for doc_id, source, text in rows:
        size = len((text or "").split())
        sizes[source] = sizes.get(source, 0) + size
        assert by_id[doc_id].size == size and 0 <= by_id[doc_id].taken <= 2 * size
    targets = shared(sizes)
    for source, target in targets.items():
        own = [by_id[k] for k, s, _ in rows if s == source]
        assert all(r.source_size == sizes[source] and r.target == pytest.approx(target) for r in own)
        assert sum(r.taken for r in own) == pytest.approx(target, rel=0.01, abs=5)


def test_reruns_agree_however_the_table_is_cut(spark):
    df, _ = documents(spark, 2, 1500)
    runs = [sorted(map(tuple, mix_sources(x).select("doc_id", "taken").collect())) for x in (df, df.repartition(7), df.coalesce(1))]
    assert runs[0] == runs[1] == runs[2]


def test_many_groups_meet_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr("tallyhouse.llm.mixing.LEAF", 40)
    df, rows = documents(spark, 3, 3000)
    found = mix_sources(df)
    sums = found.join(df.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("x")).collect()
    assert all(r.t == pytest.approx(r.x, rel=0.01, abs=5) for r in sums)


def test_pivot_keeps_expectations():
    rng = np.random.default_rng(4)
    sizes = np.array([9, 7, 7, 4, 2, 1, 1])
    total = np.zeros(len(sizes))
    for _ in range(4000):
        shares = np.full(len(sizes), 0.3)
        held = pivot(sizes, shares, rng)
        assert sum(shares * sizes) == pytest.approx(0.3 * sizes.sum())
        assert all(x in (0, 1) for k, x in enumerate(shares) if k != held)
        total += shares
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_edge_cases(spark):
    rows = [(None, "a", "x y"), (None, "a", "x y"), (1, None, None), (1, None, "é 中"), (2, "b", "w " * 200_000), (2, "b", "w " * 200_000)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", size int, copies int")
    found = mix_sources(df).collect()
    assert sorted(r.size for r in found) == [0, 2, 2, 2, 200_000, 200_000]
    assert mix_sources(df.limit(0)).count() == 0


def test_equal_rows_are_dealt_over_groups(spark, tmp_path, monkeypatch):
    """A third of the rows is one row: no group takes them all, the targets hold and reruns over the same files agree."""
    import tallyhouse.llm.mixing as module

    monkeypatch.setattr(module, "LEAF", 200)
    monkeypatch.setattr(module, "SHARE", 100)
    df, rows = documents(spark, 5, 2000)
    hot = spark.range(1000).selectExpr("cast(NULL AS long) AS doc_id", "'a' AS source", "'w w w w w' AS text")
    df.select("doc_id", "source", "text").unionByName(hot).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    runs = [sorted((r.doc_id or -1, r.source_size, r.taken) for r in mix_sources(docs).collect()) for _ in range(2)]
    assert runs[0] == runs[1] and len(runs[0]) == 3000
    found = mix_sources(docs)
    taken = found.groupBy("source_size").agg(F.sum("taken").alias("t"), F.max("target").alias("x")).collect()
    assert all(r.t == pytest.approx(r.x, rel=0.01, abs=5) for r in taken)
