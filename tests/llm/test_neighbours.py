import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm.neighbours import axes, choose, cosines, hadamard, nearest, unit


def brute(rows, queries, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None}
    out = {}
    for q in queries:
        s = []
        for i, v in good.items():
            if i != q:
                s.append((-float((good[q] * v).sum() / (np.sqrt((good[q] ** 2).sum()) * np.sqrt((v**2).sum()))), i))
        out[q] = sorted(s)[:k]
    return out


@pytest.mark.parametrize("block", [1024, 50])
def test_recall_and_scores(spark, block):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 64)).astype(np.float32)
    x[500:900] = x[500]  # a common vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nearest(df, F.col("vec_id") % 50 == 0, block=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], -r.score, r.vec_id))
    want = brute(rows, range(0, 2000, 50), 5)
    hits = 0
    for q, best in want.items():
        rows_ = sorted(got[q])
        assert [r for r, _, _ in rows_] == [1, 2, 3, 4, 5]
        hits += len({i for _, _, i in rows_} & {i for _, i in best})
        known = dict((i, s) for s, i in brute(rows, [q], 2000)[q])
        assert all(s == pytest.approx(known[i], abs=1e-12) for _, s, i in rows_)
    assert hits / (5 * len(want)) >= 0.9
    assert [i for _, _, i in sorted(got[500])] == [501, 502, 503, 504, 505]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [0.0, 0.0, 0.0]), (3, None), (4, [1.0, None, 0.0]), (5, [nan, 1.0, 0.0]),
            (6, [inf, 1.0, 0.0]), (7, [1.0, 1.0, 0.0]), (None, [1.0, 0.0, 0.0]), (50, [1.0, 0.0, 0.0]), (8, [1.0]), (1, [2.0, 0.0, 0.0]), (100, None)]
    df = spark.createDataFrame([(*r, 1, 2.0) for r in rows], "vec_id long, embedding array<double>, rank int, score double")
    got = {}
    for r in nearest(df, F.col("vec_id") % 50 == 0, probes=6).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: [i for _, i, _ in sorted(v)] for q, v in got.items()} == {0: [1, 50, 7], 50: [0, 1, 7]}
    assert sorted(got[0])[2][2] == pytest.approx(1 / math.sqrt(2))
    assert nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert nearest(df, F.lit(False)).count() == 0


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose((hadamard(x) ** 2).sum(axis=1), (x**2).sum(axis=1))
    assert np.allclose(hadamard(hadamard(x)), x)
    a = axes(x, 0, 1, 4)
    assert a.shape == (5, 4) and (axes(x, 0, 1, 1)[:, 0] == a[:, 0]).all()


@pytest.mark.parametrize("block", [1024, 4])
def test_repeats_of_the_nearest_id_leave_room_for_others(spark, block):
    rows = [(0, [1.0, 0.0, 0.0])] + [(1, [1.0, 0.01, 0.0])] * 12 + [(1, [1.0, 0.02, 0.0])] * 3
    rows += [(i, [1.0, 0.1 * i, 0.0]) for i in range(2, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id, r.score) for r in nearest(df, F.col("vec_id") == 0, probes=8, block=block).collect())
    assert [(r, i) for r, i, _ in got] == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    assert got[0][2] == pytest.approx(1 / math.sqrt(1 + 0.01**2), abs=1e-12)


def test_queries_that_find_too_few_are_compared_with_all(spark):
    rng = np.random.default_rng(11)
    q = rng.normal(size=64)
    rows = [(0, q.tolist())] + [(i, (-q + 0.01 * rng.normal(size=64)).tolist()) for i in range(1, 40)]
    for rows_, block in ((rows, 1024), (rows, 8), (rows[:4], 1024)):
        df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>")
        got = sorted((r.query_id, r["rank"], r.vec_id) for r in nearest(df, F.col("vec_id") < 2, block=block).collect())
        want = brute(rows_, [0, 1], 5)
        assert got == [(i, n + 1, v) for i in (0, 1) for n, (_, v) in enumerate(want[i])]


def test_clustered_vectors_meet_few_rows(spark):
    """Where neighbours are near, the fitted plan compares a small share of the rows and finds nearly all."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(200, 64))
    x = centres[rng.integers(0, 200, 4000)] + 0.5 * rng.normal(size=(4000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = unit(x)
    s = u[::20] @ u.T
    s[np.arange(200), np.arange(0, 4000, 20)] = -9
    true = np.argsort(-s, axis=1)[:, :5]
    plan = choose(u[::20][:64], u[true[:64].ravel()], np.repeat(np.arange(64), 5), u[1::2], 42, 0.95, 4, 2)
    assert plan.recall >= 0.95 and plan.met < 0.06
    got = {}
    for r in nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(got) == 200
    assert sum(len(got[20 * i] & set(t.tolist())) for i, t in enumerate(true)) / 1000 >= 0.9


def test_three_hashes_and_large_groups(spark, monkeypatch):
    """Dealing by more axes, and groups cut into blocks, change nothing but the cost."""
    monkeypatch.setattr("lectern.llm.neighbours.ROWS_PER_CELL", 0)
    rng = np.random.default_rng(9)
    x = np.repeat(rng.normal(size=(30, 8)), 20, axis=0) + 0.05 * rng.normal(size=(600, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, range(0, 600, 50), 5)
    for block in (16, 4096):
        got = {}
        for r in nearest(df, F.col("vec_id") % 50 == 0, block=block).collect():
            got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        hits = sum(len({i for _, i in got[q]} & {i for _, i in b}) for q, b in want.items())
        assert hits >= 0.9 * 60 and all(sorted(r for r, _ in v) == [1, 2, 3, 4, 5] for v in got.values())


def test_other_lengths_are_searched_among_themselves(spark):
    rows = [(i, [1.0, i / 10, 0.0]) for i in range(10)] + [(100 + i, [1.0, i / 10]) for i in range(4)] + [(7, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("vec_id").isin(0, 7, 100)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(got[100]) == [(1, 101), (2, 102), (3, 103)]
    assert [i for _, i in sorted(got[0])] == [1, 2, 3, 4, 5] and [i for _, i in sorted(got[7])][0] in (6, 8)


def test_a_common_vector_is_one_entry(spark):
    """Copies of one vector count by their smallest ids, whichever query asks."""
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(300)] + [(1000 + i, [1.0, 2.0, 3.0, 4.0 + i / 100]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("vec_id").isin(0, 3, 250, 1004), block=16).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert {q: [i for _, i in sorted(v)] for q, v in got.items() if q < 1000} == {0: [1, 2, 3, 4, 5], 3: [0, 1, 2, 4, 5], 250: [0, 1, 2, 3, 4]}
    assert {i for _, i in got[1004]} == {i for _, i in brute(rows, [1004], 5)[1004]}


def test_scores_of_very_large_and_small_vectors(spark):
    """Vectors times 1e200 or 1e-200 have the scores of the same vectors."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(40, 6))
    schema = "vec_id long, embedding array<double>"
    found = []
    for scale in (np.ones(40), np.resize([2.0**660, 2.0**-660, 1.0], 40)):
        df = spark.createDataFrame([(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(x, scale))], schema)
        found.append(sorted(map(tuple, nearest(df, F.col("vec_id") % 10 == 0).collect())))
    assert found[0] == found[1] and len(found[0]) == 20 and all(r[3] is not None for r in found[0])
    q, v = np.full((1, 3), 1e200), np.full((1, 3), 1e-200)
    assert cosines(q, v)[0] == pytest.approx(1.0)


def test_an_id_that_shares_a_vector_with_a_better_placed_id_is_found(spark):
    """Id 1 has a nearer vector of its own, so its second row counts for id 9 only; rows of one id do not use up places."""
    rows = [(0, [1.0, 0.0, 0.0]), (1, [1.0, 0.01, 0.0]), (1, [1.0, 0.05, 0.0]), (9, [1.0, 0.05, 0.0])]
    rows += [(1, [1.0, 0.02 + i / 1e4, 0.0]) for i in range(30)] + [(i, [1.0, 0.1 * i, 0.0]) for i in range(2, 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["rank"], r.vec_id) for r in nearest(df, F.col("vec_id") == 0, probes=8).collect())
    assert got == [(1, 1), (2, 9), (3, 2), (4, 3), (5, 4)]
