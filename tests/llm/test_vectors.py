"""Embedding near-duplicates against brute force, and components against union-find."""

import random

import numpy as np

from valuepay.llm import vectors
from valuepay.llm.components import components


def union_find(n, pairs):
    root = list(range(n))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(x) for x in range(n)]


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 16))
    near = [x[0] + rng.normal(size=16) * s for s in rng.uniform(0.05, 0.3, 700)]       # a large group, some at the limit
    chain = [np.cos(a) * x[1] / np.linalg.norm(x[1]) + np.sin(a) * np.linalg.qr(x[1:3].T)[0][:, 1] for a in np.arange(0, 2, 0.3)]
    rows = [v for v in [*x, *near, *chain, *[x[5]] * 5]]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0]]
    data = [(i, [float(a) for a in np.float32(v)]) for i, v in enumerate(rows)]
    data += [(len(rows) + i, v) for i, v in enumerate(odd)] + [(None, [float(a) for a in np.float32(x[5])])]
    df = spark.createDataFrame([(i, v, 1, "x", 0.0) for i, v in data], "vec_id long, embedding array<float>, label int, uid string, radius double")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    assert len(got) == len(data)
    m = np.array(np.float32([*rows, x[5]]), float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hit = m @ m.T >= 0.95
    np.fill_diagonal(hit, False)
    root = union_find(len(m), zip(*np.nonzero(hit)))
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (hit[i].sum(), root[i], root[i] == i), i
    for i in range(len(rows), len(rows) + 6):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    a, b = len(rows) + 6, len(rows) + 7
    assert (got[a]["n_links"], got[b]["component_id"]) == (1, a)
    assert got[None]["component_id"] == 5 and not got[None]["kept"]


def test_a_loose_group_far_larger_than_the_windows(spark):
    rng = np.random.default_rng(11)
    size, width = vectors.WINDOW * vectors.PASSES + 900, 64
    center = rng.normal(size=width)
    noise = rng.normal(size=(size, width)) * np.linalg.norm(center) / 8 * rng.uniform(0.17, 0.24, (size, 1))  # no two collapse
    x = np.float32([*(center + noise), *rng.normal(size=(300, width)), *[center + noise[0]] * 3])
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df).collect()}
    m = x.astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hit = m @ m.T >= 0.95
    np.fill_diagonal(hit, False)
    links = hit.sum(axis=1)
    assert 0.2 < hit[:size, :size].mean() < 0.99
    assert sum(r["n_links"] for r in got.values()) == links.sum()
    assert [got[i]["n_links"] for i in range(len(x))] == links.tolist()
    root = union_find(len(x), ((i, j) for i in range(len(x)) for j in np.flatnonzero(hit[i])[:1].tolist()))
    whole = {i for i in range(len(x)) if links[i]}
    assert {got[i]["component_id"] for i in whole} == {root[i] for i in whole} == {min(whole)}


def test_passes_go_on_until_nothing_new_is_found(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    near = 0.955 * x + np.sqrt(1 - 0.955**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate([*x, *near])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["component_id"] for r in vectors.near_vectors(df, passes=1).collect() if r["n_links"] == 1}
    assert got == {i: i % 3000 for i in range(6000)}
    link = float(np.arccos(0.95))
    assert vectors.passes_for(100, link) == 1 < vectors.passes_for(50_000, link) < vectors.passes_for(2_000_000, link)


def test_near_vectors_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(df).count() == 0


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7)]
    df = spark.createDataFrame(pairs + [(None, 3)], "a long, b long")
    root = union_find(461, pairs)
    got = {r["id"]: r["component"] for r in components(df).collect()}
    for i in range(461):
        assert got.get(i, i) == root[i]
    assert components(df.limit(0)).count() == 0
