import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm.ann import nearest_neighbours
from tallyhouse.llm.embedding_dedup import _recall, embedding_near_duplicates
from tallyhouse.llm.nndescent import best, decode, encode

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [
    (900, None), (901, []), (902, [0.0] * 8), (903, [1.0, None] + [0.0] * 6), (904, [math.nan] * 8), (905, [math.inf] + [1.0] * 7), (None, [1.0] * 8),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def clusters(seed, n, groups, dims=24):
    """Vectors far apart, and groups of near copies, some larger than any neighbour list."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dims))
    for size, noise in groups:
        centre = rng.normal(size=dims)
        rows = np.vstack([rows, centre + noise * rng.normal(size=(size, dims))])
    rows = rows[rng.permutation(len(rows))].astype(np.float32).astype(float)
    return [(3 * k, list(row)) for k, row in enumerate(rows)]


def brute_links(rows, threshold):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    component = {}
    for k in range(len(ids)):
        todo = [k] if ids[k] not in component else []
        while todo:
            at = todo.pop()
            if ids[at] not in component:
                component[ids[at]] = ids[k]
                todo.extend(np.flatnonzero(linked[at]))
    return {i: (int(linked[k].sum()), component[i], component[i] == i) for k, i in enumerate(ids)}


def test_links_by_brute_force(spark):
    rows = clusters(1, 600, [(150, 0.1), (60, 0.22), (2, 0.1), (2, 0.2), (3, 0.25), (2, 0.3)])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_near_duplicates(frame(spark, rows), k=8).collect()}
    assert got == brute_links(rows, 0.9)


def test_groups_larger_than_the_lists_are_linked(spark):
    """Vectors 0.99 alike inside a group and about 0.93 between groups fill each other's lists with their own group."""
    rng = np.random.default_rng(3)
    base = np.linalg.qr(rng.normal(size=(32, 8)))[0].T
    rows = [list(row) for row in rng.normal(size=(200, 32))]
    for group, mix in enumerate(([1, 0.0, 0], [1, 0.39, 0], [1, 0.78, 0], [0, 0, 1], [0, 0.2, 1])):
        centre = np.array(mix) @ base[:3] + (0 if group < 3 else 0.3 * base[4])
        centre /= np.linalg.norm(centre)
        noise = rng.normal(size=(230, 32))
        rows += [list(row) for row in centre + 0.1 * noise / np.linalg.norm(noise, axis=1, keepdims=True)]
    rows = [(int(k), [float(np.float32(x)) for x in rows[at]]) for k, at in enumerate(rng.permutation(len(rows)))]
    found = embedding_near_duplicates(frame(spark, rows)).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == brute_links(rows, 0.9)


def test_an_audit_that_fails_is_an_error(spark, monkeypatch):
    monkeypatch.setattr("tallyhouse.llm.embedding_dedup._recall", lambda *_: 0.5)
    with pytest.raises(RuntimeError):
        embedding_near_duplicates(frame(spark, clusters(2, 20, [(3, 0.1)])), k=2)


def test_the_audit_counts_each_vector_the_same(spark):
    rows = [(k, [1, k / 1000, 0, 0, 0]) for k in range(60)] + [(100, [0, 0, 1, 0, 0]), (101, [0, 0, 1, 0.1, 0]), (102, [0, 0, 0, 0, 1]), (103, [0, 0, 0, 0.1, 1])]
    nodes = spark.createDataFrame([(i, np.array(v, dtype=float).tobytes()) for i, v in rows], "id long, raw binary")
    found = spark.createDataFrame([(k, 0) for k in range(60)], "id long, component long")
    assert _recall(nodes, found, 0.9, 5) == pytest.approx(60 / 64)


def test_links_of_copies_and_odd_vectors(spark):
    rows = [(k, [1, 2, 3, 4, 0, 0, 0, 0]) for k in range(400)] + [(500, [2, 4, 6, 8, 0, 0, 0, 0]), (501, [-1, -2, -3, -4, 0, 0, 0, 0]), (502, [1e30] + [0] * 7)]
    df = frame(spark, [*rows, (3, rows[3][1]), *ODD]).withColumn("n_links", F.lit("x")).withColumn("raw", F.lit(1))
    found = embedding_near_duplicates(df).collect()
    assert len(found) == len(rows) + 1 + len(ODD)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert got.pop(None) == (0, None, True)
    for i, _ in ODD[:-1]:
        assert got[i] == (0, i, True)
    assert got[0] == (400, 0, True) and got[399] == (400, 0, False) and got[500] == (400, 0, False)
    assert got[501] == (0, 501, True) and got[502] == (0, 502, True)
    assert embedding_near_duplicates(df.limit(0)).count() == 0


def test_codes_and_best():
    x = np.random.default_rng(0).normal(size=(50, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    assert np.abs(decode(encode(x)) - x).max() < 0.01
    ids, nbrs, sims, old = (np.array(v) for v in ([1, 1, 1, 0, 1], [5, 5, 6, 1, 7], [0.5, 0.5, 0.9, 0.1, 0.5], [False, True, False, True, True]))
    i, n, s, o = best(ids, nbrs, sims, old.astype(bool), 2)
    assert i.tolist() == [0, 1, 1] and n.tolist() == [1, 6, 5] and o.tolist() == [True, False, True]


def brute_nearest(rows, queries, k):
    out = {}
    for q, v in rows:
        if q in queries:
            scored = sorted(((-float(np.dot(v, w)), i) for i, w in rows if i != q))[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def found_nearest(found):
    out = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_with_vectors_of_all_lengths(spark):
    rng = np.random.default_rng(5)
    rows = [(k, list(v * s)) for k, (v, s) in enumerate(zip(rng.normal(size=(2500, 32)).astype(np.float32), rng.uniform(0.5, 1.5, 2500), strict=True))]
    rows = [(k, [float(np.float32(x)) for x in v]) for k, v in rows]
    got = found_nearest(nearest_neighbours(frame(spark, rows), F.col("id") % 20 == 0).collect())
    want = brute_nearest(rows, set(range(0, 2500, 20)), 20)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    exact = {q: dict(brute) for q, brute in brute_nearest(rows[:300], {0, 20}, 299).items()}
    for q in (0, 20):
        assert all(score == pytest.approx(exact[q][i], abs=1e-12) for i, score in got[q] if i in exact[q])


def test_nearest_among_copies_goes_by_id(spark):
    rows = [(k, [1, 2, 3, 4, 0, 0, 0, 0]) for k in range(200)] + [(k, [0, 0, 0, 0, 4, 3, 2, k]) for k in range(200, 260)]
    got = found_nearest(nearest_neighbours(frame(spark, [*rows, *ODD]), F.col("id") % 20 == 0).collect())
    assert got == brute_nearest(rows, set(range(0, 260, 20)), 20)


def test_few_rows_give_all_candidates(spark):
    rows = [(0, [1, 0]), (20, [1, 1]), (3, [-1, 0])]
    df = frame(spark, [*rows, rows[0]]).withColumn("score", F.lit(1)).withColumn("id", F.lit(2))
    assert found_nearest(nearest_neighbours(df, F.col("id") % 20 == 0).collect()) == brute_nearest(rows, {0, 20}, 20)
    assert nearest_neighbours(df.limit(1), F.col("id") % 20 == 0).count() == 0
    assert nearest_neighbours(df.limit(0), F.col("id") % 20 == 0).count() == 0
