from __future__ import annotations

import math

import numpy as np
import pytest

from mercato.llm.op12_embedding_dedup import Near, Unit, cosines, near_copies, unite

SCHEMA = "vec_id bigint, vec array<double>, label string"
SMALL = Near(interval_bytes=1, block_rows=16, fanout=2, bound_dims=5, grid_dims=2, units_per_task=2)


def expected(rows, least=0.93):
    """Brute force: (vec_id, n_links, component_id, kept) of (vec_id, vec, label), sorted."""

    def links(a, b):
        if a[2] is None or a[2] != b[2] or a[0] is None or b[0] is None:
            return False
        x, y = a[1], b[1]
        for v in (x, y):
            if not v or any(c is None or not math.isfinite(c) for c in v) or not any(v):
                return False
        if len(x) != len(y):
            return False
        return cosines(np.array([x], dtype=float), np.array([y], dtype=float))[0] >= least

    n = len(rows)
    near = [[j for j in range(n) if j != i and links(rows[i], rows[j])] for i in range(n)]
    component = list(range(n))
    for start in range(n):
        stack = [start]
        while stack:
            i = stack.pop()
            for j in near[i]:
                if component[j] > component[start]:
                    component[j] = component[start]
                    stack.append(j)
    least_id = {}
    for i, c in enumerate(component):
        if rows[i][0] is not None:
            least_id[c] = min(least_id.get(c, rows[i][0]), rows[i][0])
    out = []
    for i, c in enumerate(component):
        own = least_id.get(c)
        out.append((rows[i][0], len(near[i]), own, rows[i][0] == own))
    return sorted(out, key=str)


def clusters(seed, rows, size, labels=("a", "b"), width=0.08):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, size))
    out = []
    for i in range(rows):
        if i % 3:
            v = centres[rng.integers(6)] + width * math.sqrt(size) * 0.5 * rng.standard_normal(size)
        else:
            v = rng.standard_normal(size)
        out.append((int(1000 - i), (v * rng.uniform(0.1, 9)).tolist(), labels[rng.integers(len(labels))]))
    return out


def got(spark, rows, near=None):
    return sorted(map(tuple, near_copies(spark.createDataFrame(rows, SCHEMA), near).collect()), key=str)


@pytest.mark.parametrize("near", [Near(), SMALL])
def test_against_brute_force(spark, near):
    rows = clusters(1, 300, 8) + clusters(2, 60, 3, labels=("a", None))
    want = expected(rows)
    assert 20 < sum(not r[3] for r in want) < 340
    assert got(spark, rows, near) == want


@pytest.mark.parametrize("near", [Near(), SMALL])
def test_many_equal_vectors_and_a_chain(spark, near):
    copies = [(i, [1.0, 2.0, 3.0], "a") for i in range(500, 700)]
    chain = [(i, [math.cos(i * 0.2), math.sin(i * 0.2), 0.0], "b") for i in range(15)]  # neighbours link, others don't
    rows = copies + chain + [(3000, [2.0, 4.0, 6.0], "a"), (3001, [1.0, 2.0, 3.0], "c")]
    assert got(spark, rows, near) == expected(rows)


@pytest.mark.parametrize("near", [Near(), SMALL])
def test_odd_rows(spark, near):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a"), (2, [1.0, 0.0], None), (3, None, "a"), (4, [], "a"), (5, [0.0, 0.0], "a"),
        (6, [nan, 1.0], "a"), (7, [inf, 1.0], "a"), (8, [None, 1.0], "a"), (None, [1.0, 0.0], "a"), (9, [1e300, 1e299], "a"),
        (10, [1e-300, 1e-301], "a"), (11, [1.0, 0.0, 0.0], "a"), (12, [5.0], "a"), (13, [6.0], "a"), (14, [-6.0], "a"),
        (-1, [0.0, 1.0], "a"), (1, [0.0, 2.0], "a"),
    ]
    want = expected(rows)
    assert (None, 0, None, True) in want  # no id: a row of its own
    assert got(spark, rows, near) == want


def test_odd_table(spark, odd_dir, result):
    rows = spark.read.parquet(f"{odd_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    want = expected([tuple(r) for r in rows])
    assert sorted((tuple(r) for r in result("op12", odd_dir)), key=str) == want


def test_small_table(spark, result):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    assert sorted((tuple(r) for r in result("op12")), key=str) == expected([tuple(r) for r in rows])


def test_unite():
    rng = np.random.default_rng(3)
    parent, own = np.arange(200), list(range(200))
    for _ in range(20):
        a, b = rng.integers(0, 200, 9), rng.integers(0, 200, 9)
        unite(parent, a.copy(), b.copy())
        for x, y in zip(a, b, strict=True):
            p, q = own[x], own[y]
            own = [min(p, q) if c in (p, q) else c for c in own]
    root = parent
    while (root != root[root]).any():
        root = root[root]
    assert root.tolist() == own


def test_distant_blocks_are_skipped(monkeypatch):
    """Two far groups in one interval: no cosine between them is worked out."""
    seen = []
    block = Unit.block
    monkeypatch.setattr(Unit, "block", lambda self, *a: (seen.append(a), block(self, *a))[1])
    near = Near(block_rows=8, bound_dims=2)
    v = np.concatenate([np.tile([1.0, 0.01], (32, 1)), np.tile([0.01, 1.0], (32, 1))])
    done = Unit([v], [np.ones(64, np.int64)], {}, near)
    assert all((a1 <= 32) == (b1 <= 32) for _, a1, _, b1, *_ in seen)
    assert done.links[0].tolist() == [31] * 64
    assert done.roots().tolist() == [0] * 32 + [32] * 32
