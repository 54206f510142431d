from __future__ import annotations

import numpy as np

from docpipe.llm import knn

KEYS = ["id", "part"]
SCHEMA = "id long, part int, vec array<float>, cosine string, rank string"


def table(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), 0, None if v is None else [float(f) for f in v], "clash", "clash") for i, v in zip(ids, x, strict=True)], SCHEMA)


def clusters(n, size, spread=0.04, seed=0, dim=64):
    r = np.random.RandomState(seed)
    c = np.repeat(r.randn(n // size, dim), size, axis=0)
    return (c / np.linalg.norm(c, axis=1, keepdims=True) + spread * r.randn(n, dim)).astype(np.float32)


def truth(x, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    return np.argsort(-s, axis=1)[:, :k]


def recall(df, x, k=5):
    got = {(r.id, r.n_id) for r in df.collect()}
    want = {(i, int(j)) for i, row in enumerate(truth(x, k)) for j in row}
    return len(got & want) / len(want)


def test_recall_against_brute_force(spark):
    x = clusters(3000, 10)
    assert recall(knn.nearest_vectors(table(spark, x), KEYS, "vec"), x) >= 0.9


def test_a_third_of_all_rows_in_one_slot(spark):
    x = np.concatenate([clusters(800, 10), clusters(400, 400, 0.005, seed=3)])
    found = knn.nearest_vectors(table(spark, x), KEYS, "vec", slot_cap=100)
    got = {}
    for r in found.collect():
        got.setdefault(r.id, set()).add(r.n_id)
    hot = [len(got.get(i, set()) & set(truth(x)[i].tolist())) for i in range(800, 1200)]
    assert sum(hot) / (5 * len(hot)) >= 0.9
    assert all(len(v) == 5 for v in got.values())


def test_what_hashing_cannot_split_is_compared_in_blocks(spark):
    x = clusters(300, 300, 0.005, seed=4)
    found = knn.nearest_vectors(table(spark, x), KEYS, "vec", slot_cap=20, levels=1, block=64)
    assert recall(found, x) > 0.9


def test_crowded_slots_lose_nothing(spark):
    # a tight group without finer groups inside; each slot holds a large part of it
    x = np.concatenate([clusters(800, 10), clusters(400, 400, 0.03, seed=3)])
    plain = {tuple(r) for r in knn.nearest_vectors(table(spark, x), KEYS, "vec").collect()}
    crowded = {tuple(r) for r in knn.nearest_vectors(table(spark, x), KEYS, "vec", slot_cap=100, block=60).collect()}
    key = lambda rows: {(r[0], r[3]) for r in rows}
    assert len(key(plain) & key(crowded)) >= 0.999 * len(plain)


def test_recall_does_not_fall_with_the_projections():
    x = clusters(3000, 10, 0.03)
    want, unit = truth(x), knn._unit(x)
    for m in (8, 9, 11, 13, 16):
        slots = knn.slot_keys(unit, m, knn.tables_for(m), knn.probes_for(m), knn.WIDTH)
        assert np.mean([bool(np.intersect1d(slots[i], slots[j]).size) for i in range(0, 3000, 10) for j in want[i]]) >= 0.98


def test_vectors_without_slot_mates_find_all_their_neighbours(spark, monkeypatch):
    monkeypatch.setattr(knn, "projections_for", lambda rows: 16)
    x = np.random.RandomState(7).randn(60, 64).astype(np.float32)
    found = knn.nearest_vectors(table(spark, x), KEYS, "vec", block=25)
    assert recall(found, x) == 1
    assert found.count() == 300


def test_edges(spark):
    a, b = [1.0] * 4, [1.0, 0.0, 0.0, 0.0]
    rows = [a, a, b, [0.0] * 4, None, [], [float("nan")] * 4, [2.0] * 4, [1.0, 1.0]]
    df = table(spark, rows)
    got = sorted((r.id, r.rank, r.n_id, round(r.cosine, 6)) for r in knn.nearest_vectors(df.union(df), KEYS, "vec").collect())
    # the copy (id 1) stands under id 0; the vector of another length has no others; a longer copy is another vector
    assert got == [(0, 1, 7, 1.0), (0, 2, 2, 0.5), (2, 1, 0, 0.5), (2, 2, 7, 0.5), (7, 1, 0, 1.0), (7, 2, 2, 0.5)]
    pairs = knn.similar_pairs(knn.nearest_vectors(df, KEYS, "vec"), KEYS)
    assert sorted((r.id_a, r.id_b) for r in pairs.collect()) == [(0, 2), (0, 7), (2, 7)]
    assert {(r.id, r.rep_id) for r in knn.vector_copies(df, KEYS, "vec").collect()} == {(0, 0), (1, 0), (2, 2), (7, 7), (8, 8)}


def test_empty_table(spark):
    assert knn.nearest_vectors(table(spark, []), KEYS, "vec").count() == 0
