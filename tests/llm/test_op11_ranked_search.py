from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from mercato.llm.op11_ranked_search import Ranking, length_factors, search, shared_sets, terms_in

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = Ranking(block_items=3, block_terms=60, mined_classes=4, accumulator_bytes=20_000)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(docs, items):
    """Brute force: (item_id, text, rank, doc_id, score) of (doc_id, text) and (item_id, text)."""
    counts = [Counter(TERM.findall(lowered(text))) for _, text in docs]
    n_docs, total = sum(map(bool, counts)), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    out = []
    for item_id, text in sorted(set(items), key=str):
        asked = Counter(TERM.findall(lowered(text)))
        scores = []
        for (doc_id, _), own in zip(docs, counts, strict=True):
            m = 100 - 75 + (75 * sum(own.values()) * n_docs) // total if total else 0
            score = 0
            for term, q in asked.items():
                if term in own:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += q * w * ((1_000_000_000 * own[term]) // (1000 * own[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:10], 1)]
    return sorted(out, key=str)


def tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return docs, spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text")


@pytest.mark.parametrize("ranking", [Ranking(), SMALL])
def test_small_table_against_brute_force(spark, ranking):
    docs, items = tables(spark, SF_DIR)
    want = expected([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert len(want) > 100
    assert sorted(map(tuple, search(docs, items, ranking).collect()), key=str) == want


@pytest.mark.parametrize("ranking", [None, SMALL])
def test_odd_rows_against_brute_force(spark, odd_dir, ranking):
    docs, items = tables(spark, odd_dir)
    want = expected([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    got = sorted(map(tuple, search(docs, items, ranking).collect()), key=str)
    assert got == want
    assert {r[0] for r in got} == {None, 3, 4, 6}
    assert any(r[2] is None for r in got)  # a document without an id is found


def test_no_items(spark, odd_dir):
    docs, items = tables(spark, odd_dir)
    assert search(docs, items.filter("item_id = 2")).collect() == []


def test_registered_query(result):
    rows = result("op11")
    by_item = {}
    for r in rows:
        by_item.setdefault(r["item_id"], []).append(r)
    for own in by_item.values():
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(own) + 1)) and len(own) <= 10
        assert [(-r["score"], r["doc_id"]) for r in own] == sorted((-r["score"], r["doc_id"]) for r in own)


@pytest.mark.parametrize("mined", [0, 3, 200])
def test_shared_sets_add_up(mined):
    rng = random.Random(mined)
    common = [[rng.randrange(60) for _ in range(8)] for _ in range(6)]
    items = [
        Counter(rng.choice(common) + rng.choice(common) + [rng.randrange(60) for _ in range(rng.randrange(9))])
        for _ in range(40)
    ] + [Counter(), Counter([7]), Counter([7, 7])]
    graph = shared_sets(items, 60, mined)
    rows = np.zeros((graph.rows, 5), dtype=np.int64)
    rows[:60] = np.random.default_rng(1).integers(0, 1000, (60, 5))
    leaves = rows[:60].copy()
    graph.evaluate(rows)
    for item, row in zip(items, graph.items, strict=True):
        if item:
            want = sum(n * leaves[t] for t, n in item.items())
            assert (rows[row] == want).all()
    if mined > 3:  # sharing saves sums
        direct = sum(len(i) for i in items)
        assert sum(len(s) for s in graph.steps) < 0.8 * direct


def test_terms_of_long_texts_and_odd_characters():
    text = "aB\x00c_1-Ünï日本 " * 200_000 + "x" * 3_000_000
    assert [t for piece in terms_in(text) for t in piece] == [t.encode() for t in TERM.findall(lowered(text))]
    assert list(terms_in(None)) == []


def test_length_factors_beyond_64_bits():
    n = np.array([1, 10**9], dtype=np.int64)
    assert length_factors(n, 10**11, 10**14).tolist() == [25 + 75 * 10**11 // 10**14, 25 + 75 * 10**20 // 10**14]
