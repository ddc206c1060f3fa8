import math

import numpy as np
import pytest

from cubeguard.llm import cover_search as C

SCHEMA = "vec_id long, embedding array<float>, label int, v string, dim string"


def brute(own, k=C.TOP, every=C.EVERY):
    ints = {}
    for i, e, *_ in own:
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e):
            ints.setdefault((i, tuple(math.floor(256 * float(np.float32(x))) for x in e)), None)
    out = []
    for i, q in ints:
        if i % every == 0:
            ranked = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), j) for j, v in ints if j != i and len(v) == len(q))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(ranked[:k])]
    return sorted(out)


def found(spark, own, **kw):
    df = spark.createDataFrame([(i, e, 1, "clash", "clash") for i, e in own], SCHEMA)
    return sorted(map(tuple, C.top_k(df, **kw).select("query_id", "rank", "vec_id", "score").collect()))


@pytest.mark.parametrize("kind", ["spread", "clusters", "copies"])
def test_exact(spark, kind, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((700, 6))
    if kind == "clusters":
        x = rng.standard_normal((9, 6))[rng.integers(0, 9, 700)] * 3 + 0.02 * x
    if kind == "copies":
        x[:400] = x[0]
    own = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    monkeypatch.setattr(C, "ROW_BLOCK", 200)
    monkeypatch.setattr(C, "QUERY_BLOCK", 5)
    assert found(spark, own) == brute(own)


def test_awkward_vectors(spark):
    own = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []), (None, [1.0, 1.0]),
           (50, [0.5, 0.5]), (50, [0.5, 0.5]), (6, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0, 3.0]), (100, [1.0, 0.0, 0.0, 0.0])]
    got = found(spark, own)
    assert got == brute(own) and not any(q == 100 for q, *_ in got)
    assert [v for q, _, v, _ in got if q == 0] == [6, 7, 50]  # ties to the smaller id


def test_large_components_stay_exact(spark):
    own = [(0, [1e6, 3.0]), (1, [1e6, 1.0]), (2, [1e6, 2.0])]
    assert found(spark, own) == brute(own)


def test_tree_covers_its_points():
    x = np.random.default_rng(1).integers(-300, 300, (900, 4)).astype(float)
    todo, leaves = [C.cover_tree(x)], []
    while todo:
        node = todo.pop()
        assert node.centre in node.points
        assert np.sqrt(((x[node.points] - x[node.centre]) ** 2).sum(1)).max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
            centres = x[[c.centre for c in node.children]]
            gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2))
            assert gaps[~np.eye(len(centres), dtype=bool)].min(initial=np.inf) > node.radius * C.SHRINK
            todo += node.children
        else:
            leaves += node.points.tolist()
    assert sorted(leaves) == list(range(900))


def test_far_nodes_are_pruned(monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.integers(-5, 5, (500, 3)) + c for c in ([900, 0, 0], [-900, 0, 0])])
    seen = []
    rint = np.rint
    monkeypatch.setattr(C.np, "rint", lambda s: seen.append(s.size) or rint(s))
    C.search(x, np.arange(1000), x[:40], np.arange(40), 5)
    assert sum(seen) < 40 * 600


def test_empty_table(spark):
    assert found(spark, []) == []
