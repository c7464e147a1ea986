from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mercato.llm.op3_nearest_neighbours import Index, Search, _asked, _Chunk, _limit, nearest, unit


def brute(rows, queries, k=5):
    """(query, rank) to (vec_id, score) over rows of id to vector."""
    want = {}
    for q in queries:
        a = np.array(rows[q], dtype=float)
        scored = []
        for i, b in rows.items():
            if i != q:
                b = np.array(b, dtype=float)
                scored.append((-(a @ b) / (np.sqrt(a @ a) * np.sqrt(b @ b)), i))
        scored.sort(key=lambda x: (round(x[0], 12), x[1]))
        want[q] = [(i, -s) for s, i in scored[:k]]
    return want


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall(spark, result, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: r["embedding"] for r in table}
    want = brute(vectors, [i for i in vectors if i % 50 == 0])
    got = found(result("op3", folder))
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    score = {(q, i): s for q, x in brute(vectors, list(want), len(vectors)).items() for i, s in x}
    for q, own in got.items():
        assert [s for _, s in own] == sorted((s for _, s in own), reverse=True)
        for i, s in own:
            assert s == pytest.approx(score[q, i], abs=1e-12)


def test_odd_rows(result, odd_dir):
    got = found(result("op3", odd_dir))
    assert set(got) == {0, 50, 150}
    ok = {0, 1, 2, 9, 10, 11, 50, 150}
    for q, own in got.items():
        assert {i for i, _ in own} <= ok - {q}
    # Copies and multiples of the query come first, ties by smaller id.
    assert [i for i, _ in got[0]][:3] == [1, 2, 50]
    assert [i for i, _ in got[50]][:3] == [0, 1, 2]
    assert got[50][0][1] == pytest.approx(1.0)


def test_hot_vector_and_chunks(spark):
    """A third of the rows share a vector; buckets are cut into many chunks."""
    rng = np.random.default_rng(3)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.standard_normal(4).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id bigint, vec array<double>")
    whole = Search(reach=1.0, chunk_rows=16, tables=1)
    got = found(nearest(df, df.filter(F.col("vec_id") % 50 == 0), whole).collect())
    want = brute(dict(rows), range(0, 3000, 50))
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q


def test_probes_fall_and_cover():
    index = Index(Search(reach=0.999), 8, 3, 0.6)
    v = unit(np.random.default_rng(1).standard_normal((1, 8)))
    visits = list(index.probes(v[0], 0))
    assert len(visits) == len(set(visits))
    near = unit(0.6 * v + 0.8 * unit(np.random.default_rng(2).standard_normal((4000, 8))))
    hit = np.isin(index.buckets(near, 0), visits).mean()
    assert hit > 0.97
    first = np.isin(index.buckets(near, 0), visits[: max(1, len(visits) // 10)]).mean()
    assert first > 0.1


def test_large_and_small_numbers(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 1e-300]), (2, [1e300, 0.0]), (3, [0.0, -1e-300])]
    df = spark.createDataFrame(rows, "vec_id bigint, vec array<double>")
    got = found(nearest(df, df.filter("vec_id = 0"), Search(reach=1.0)).collect())[0]
    assert [i for i, _ in got] == [1, 2, 3]
    assert got[0][1] == pytest.approx(1.0) and got[2][1] == pytest.approx(-(0.5**0.5))


@pytest.mark.parametrize("cosine", [0.9, 0.99])
def test_recall_with_groups_of_near_copies(spark, cosine):
    """Four of five vectors lie in groups of 20 near copies, the others stand alone."""
    rng = np.random.default_rng(5)
    centres = np.repeat(unit(rng.standard_normal((320, 64))), 20, axis=0)
    groups = cosine**0.5 * centres + (1 - cosine) ** 0.5 * unit(rng.standard_normal((6400, 64)))
    vectors = unit(np.concatenate([groups, rng.standard_normal((1600, 64))])[rng.permutation(8000)])
    df = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id bigint, vec array<double>")
    got = found(nearest(df, df.filter("vec_id < 120")).collect())
    near = vectors[:120] @ vectors.T
    near[np.arange(120), np.arange(120)] = -2
    want = np.argsort(-near, axis=1)[:, :5]
    own = np.array([len(set(want[q]) & {i for i, _ in got.get(q, [])}) / 5 for q in range(120)])
    alone = near.max(axis=1) < 0.7
    assert own.mean() >= 0.9 and own[alone].mean() >= 0.9


def test_probing_is_spread_over_tasks(spark):
    """Few questions take long, so their partitions aren't merged by size."""
    rows = [(i, [float(i % 7), float(i % 11), 1.0 + i]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, vec array<double>")
    for tasks in (3, 5):
        plan = nearest(df, df, Search(probing_tasks=tasks))._jdf.queryExecution().executedPlan().toString()
        assert f", {tasks}), REPARTITION_BY_NUM" in plan


def test_a_query_is_one_row_for_each_chunk():
    """However many buckets it visits: here some 6000 in each table, each of which took a row with the vector."""
    index = Index(Search(), 64, 9, 0.4)
    vectors = unit(np.random.default_rng(1).standard_normal((3, 64)))
    assert min(len(index.visits(v, 0)) for v in vectors) > 3000
    rows = pa.RecordBatch.from_pydict(
        {"class": ["a", "b", "c"], "ids": pa.array([[]] * 3, pa.list_(pa.int64())), "vec": vectors.tolist()}
    )
    sent = pa.Table.from_batches(_asked(index, 4)(iter([rows]))).to_pylist()
    assert sorted((r["table"], r["chunk"], r["class"]) for r in sent) == sorted(
        itertools.product(range(2), range(4), "abc")
    )


def test_no_join_before_the_ranking(spark):
    """Buckets that queries visit were broadcast to the driver, by an estimate of their size from the queries'."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0 + i]) for i in range(300)], "vec_id bigint, vec array<double>")
    plan = nearest(df, df.filter("vec_id < 9"))._jdf.queryExecution().executedPlan().toString().splitlines()
    ranked = [i for i, x in enumerate(plan) if "MapInArrow run" in x][0]
    assert not [x for x in plan[ranked:] if "Join" in x]


@pytest.mark.parametrize("reach", [0.05, 0.5, 0.78, 0.999, 1.1])
def test_limit_is_the_last_cost_needed(reach):
    rng = np.random.default_rng(4)
    for dims in (2, 5):
        chances = rng.dirichlet([0.4] * 5, dims)
        chances[chances < 1e-4] = 0
        costs = np.where(chances > 0, -np.log(np.where(chances > 0, chances, 1)), np.inf)
        sums = sorted(s for s in map(sum, itertools.product(*costs)) if s < math.inf)
        total = np.cumsum(np.exp(-np.array(sums)))
        limit = _limit(costs, reach)
        if total[-1] < reach:
            assert limit == math.inf
        else:
            assert limit == pytest.approx(sums[int((total >= reach).argmax())], abs=1e-8)


def test_chunk_compares_rows_of_visited_buckets_only():
    rng = np.random.default_rng(6)
    rows, asked = unit(rng.standard_normal((5000, 12))), unit(rng.standard_normal((7, 12)))
    index = Index(Search(k=3, reach=0.4), 12, 5, 0.7)
    for number in range(2):
        chunk = _Chunk(index, number, rows, [[i] for i in range(len(rows))])
        at, row, score = chunk.best(asked, index.limits(asked, number), 3)
        buckets = index.buckets(rows, number)
        for q, v in enumerate(asked):
            seen = np.flatnonzero(np.isin(buckets, index.visits(v, number)))
            assert 100 < len(seen) < 4900
            want = seen[np.argsort(-(rows[seen] @ v))][:4]
            got = sorted(zip(-score[at == q], row[at == q], strict=True))
            assert [chunk.ids[r][0] for _, r in got] == want.tolist()
            assert -got[0][0] == pytest.approx(rows[want[0]] @ v)
