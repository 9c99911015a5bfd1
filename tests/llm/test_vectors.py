"""Vector searches against brute force, with ties, repeats and rows that take no part."""

import math
import random

import numpy as np
import pytest

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def fixture(spark, n=900, dims=16, copies=120):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, dims))
    x = (centres[rng.integers(0, 6, n)] + 0.4 * rng.standard_normal((n, dims))).astype(np.float32)
    x[:copies] = x[0]
    rows = [(i, [float(c) for c in v], 1, "a") for i, v in enumerate(x)]
    rows += [(5000, None, 1, "a"), (5100, [0.0] * dims, 1, "a"), (5200, [math.nan] * dims, 1, "a"), (5300, [None] + [1.0] * (dims - 1), 1, "a"), (5400, [1.0], 1, "a"), (None, rows[0][1], 1, "a"), rows[300], (5500, [math.inf] * dims, 1, "a")]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3), {**{r[0]: np.array(r[1], np.float64) for r in rows if r[0] is not None and r[0] < 5000}}, dims


def truth(vectors, step, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in ids[ids % step == 0]:
        s = x @ vectors[q]
        order = sorted((-s[j], i) for j, i in enumerate(ids) if i != q)[:k]
        out[int(q)] = [(int(i), -v) for v, i in order]
    return out


def test_multi_index_recall(spark):
    from ledgerline.llm.multi_index import nearest_neighbours

    table, vectors, dims = fixture(spark)
    got = {}
    for r in nearest_neighbours(table, centroids=16).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = truth(vectors, 20, 20)
    assert got.keys() == want.keys()
    hit = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, 21))
        assert rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        for _, i, s in rows:
            assert abs(s - vectors[q] @ vectors[i]) < 1e-9 * max(1, abs(s)) and i != q
        hit += len({r[1] for r in rows} & {i for i, _ in want[q]})
    assert hit >= 0.9 * 20 * len(want)
    assert nearest_neighbours(table.where("false")).count() == 0
    assert nearest_neighbours(table.where("vec_id = 20")).count() == 0


def test_multi_index_keeps_all_ties(spark, monkeypatch):
    from ledgerline.llm import multi_index

    monkeypatch.setattr(multi_index, "calibrated_share", lambda *_: 1.0)
    rng = np.random.default_rng(4)
    x = np.unique(rng.integers(0, 2, (1200, 10)), axis=0)
    x = rng.permutation(x[x.sum(axis=1) > 0])
    vectors = {i: v.astype(np.float64) for i, v in enumerate(x)}
    table = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()], "vec_id long, embedding array<float>")
    got = {}
    for r in multi_index.nearest_neighbours(table, centroids=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert {q: [i for _, i in sorted(rows)] for q, rows in got.items()} == {q: [i for i, _ in rows] for q, rows in truth(vectors, 20, 20).items()}


def test_traverse_meets_cells_in_order():
    from ledgerline.llm.multi_index import traverse

    rng = np.random.default_rng(0)
    a, b = rng.random(5), rng.random(7)
    sums = (a[:, None] + b[None, :]).ravel()
    assert traverse(a, b, np.ones((5, 7), int), 35) == np.argsort(sums, kind="stable").tolist()


@pytest.mark.parametrize("shard", [16384, 100])
def test_pivot_index_is_exact(spark, monkeypatch, shard):
    from ledgerline.llm import pivot_index

    monkeypatch.setattr(pivot_index, "SHARD", shard)
    table, vectors, dims = fixture(spark)
    whole = {i: np.floor(256 * v) for i, v in vectors.items()} | {5100: np.zeros(dims)}
    want = truth(whole, 50, 5)
    got = {}
    for r in pivot_index.top_products(table, pivots=6, rings=4).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert {q: [(i, s) for _, i, s in sorted(rows)] for q, rows in got.items()} == {q: [(i, int(s)) for i, s in rows] for q, rows in want.items()}
    assert pivot_index.top_products(table.where("false")).count() == 0


def test_pivot_index_on_long_vectors(spark):
    """Products beyond 2**53 are whole numbers all the same."""
    from ledgerline.llm.pivot_index import top_products

    rng = np.random.default_rng(3)
    body = rng.integers(-(2**27), 2**27, (120, 6))
    table = spark.createDataFrame([(i, [float(x) / 256 for x in v]) for i, v in enumerate(body)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_products(table, pivots=4, rings=3).collect()}
    for q in range(0, 120, 50):
        exact = sorted((-sum(int(a) * int(b) for a, b in zip(body[q], body[i], strict=True)), i) for i in range(120) if i != q)[:5]
        assert [got[q, n + 1] for n in range(5)] == [(i, -s) for s, i in exact] and -exact[0][0] > 2**53


def test_repeated_ids_leave_room_for_others(spark):
    """An id with many vectors nearer than all others takes one place, not all."""
    from ledgerline.llm.multi_index import nearest_neighbours
    from ledgerline.llm.pivot_index import top_products

    rng = np.random.default_rng(11)
    rows = [(0, [1.0, 1.0, 0.0, 0.0])] + [(1, [2.0 + j / 64, 2.0, 0.5, j / 32]) for j in range(150)]
    rows += [(i, rng.uniform(-1, 1, 4).tolist()) for i in range(2, 40)] + [(40, [0.5, 0.25, 1.0, 0.0]), (40, [-1.0, 0.0, 0.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    vectors = {}
    for i, v in rows:
        vectors.setdefault(i, []).append(np.array(v))

    def best_of(query, measure, k):
        q = min((measure(v) for v in vectors[query]), key=lambda v: (v + 0.0).tobytes())
        return sorted((-max(float(measure(v) @ q) for v in vs), i) for i, vs in vectors.items() if i != query)[:k]

    for run, measure, k, step in ((nearest_neighbours, lambda v: v, 20, 20), (top_products, lambda v: np.floor(256 * v), 5, 50)):
        got = {}
        for r in run(table, **({"recall": 2.0, "centroids": 4} if k == 20 else {"pivots": 4, "rings": 3})).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert set(got) == {i for i in vectors if i % step == 0}
        for query, found in got.items():
            want = best_of(query, measure, k)
            assert [i for i, _ in found] == [i for _, i in want] and np.allclose([s for _, s in found], [-s for s, _ in want])


def test_take_best_by_brute_force():
    from ledgerline.llm.vectors import take_best

    rng = random.Random(6)
    for _ in range(400):
        n, k = rng.randint(0, 60), rng.randint(1, 6)
        scores = np.array([float(rng.randint(0, 9)) for _ in range(n)])
        ids = [sorted(rng.sample(range(12), rng.randint(1, 3))) for _ in range(n)]
        best = {}
        for s, own in zip(scores, ids, strict=True):
            for v in own:
                best[v] = max(best.get(v, s), s)
        want = sorted(((-s, v) for v, s in best.items() if v != 3))[:k]
        assert take_best(3, scores, ids, k) == [(v, -s) for s, v in want]
