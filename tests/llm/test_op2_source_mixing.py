from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import pytest

from mercato.llm.op2_source_mixing import BILLION, GRID, Mix, mixed, prepared, schedule, weighted_sources


@pytest.fixture
def corpus(spark):
    """Three sources of very unequal size."""
    rows = [(i, "w " * (1 + i % 7), "big" if i % 20 < 16 else "mid" if i % 20 < 19 else None) for i in range(2000)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string")


def weights_of(docs, mix):
    rows = prepared(docs, "doc_id", "source", "text", mix)
    sources = weighted_sources(rows.select("_id", "_source", "_tokens", "_place"), mix)
    return rows.select("_id", "_source", "_tokens", "_place"), sources


def brute_weights(totals, mix):
    """Weights by trying every exponent's neighbourhood by plain bisection in Python."""
    t = sum(totals.values())
    share = {s: x / t for s, x in totals.items() if x}
    budget = mix.budget or t

    def at(k):
        w = {s: p ** (k / GRID) for s, p in share.items()}
        z = sum(w.values())
        w = {s: x / z for s, x in w.items()}
        entropy = -sum(x * math.log(x) for x in w.values())
        repeats = max(budget * x / totals[s] for s, x in w.items())
        if mix.whole:
            repeats = max(x / totals[s] for s, x in w.items()) / min(x / totals[s] for s, x in w.items())
        return w, entropy, repeats

    k = GRID if mix.entropy is None and mix.max_repeats is None else 0
    if mix.entropy is not None:
        low, high = 0, GRID + 1
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (mid, high) if at(mid)[1] >= mix.entropy * math.log(len(share)) - 1e-12 else (low, mid)
        k = low
    if mix.max_repeats is not None:
        low, high = -1, GRID
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (low, mid) if at(mid)[2] <= mix.max_repeats + 1e-12 else (mid, high)
        k = max(k, high)
    return {s: round(x * BILLION) for s, x in at(k)[0].items()}


MIXES = [
    Mix(),
    Mix(entropy=0.99, max_repeats=None),
    Mix(entropy=None, max_repeats=2.0),
    Mix(entropy=None, max_repeats=2.5, whole=True),
    Mix(entropy=0.999, max_repeats=1.5, budget=20_000),
    Mix(entropy=None, max_repeats=None),
]


@pytest.mark.parametrize("mix", MIXES)
def test_weights(corpus, mix):
    _, sources = weights_of(corpus, mix)
    rows = sources.collect()
    totals = {r["_source"]: r["_total"] for r in rows}
    want = brute_weights(totals, mix)
    assert {r["_source"]: r["weight"] for r in rows} == pytest.approx(want, abs=2)


@pytest.mark.parametrize("mix", [Mix(rows_per_chunk=50, block_tokens=700), Mix(whole=True, entropy=None, max_repeats=3.0)])
def test_budgets_and_blocks(corpus, mix):
    rows, sources = weights_of(corpus, mix)
    quota = {r["_source"]: r["quota"] for r in sources.collect()}
    total = {r["_source"]: r["_total"] for r in sources.collect()}
    found = schedule(rows, sources, mix).collect()
    read, slots, blocks = Counter(), defaultdict(list), defaultdict(Counter)
    for r in found:
        read[r["_source"]] += r["_tokens"]
        slots[r["block"]].append(r["slot"])
        blocks[r["block"]][r["_source"]] += r["_tokens"]
    for s in quota:
        assert quota[s] <= read[s] < quota[s] + 8  # the last document may go over
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    # Each block has about every source's weight.
    for own in blocks.values():
        if sum(own.values()) > 500:
            for s in quota:
                assert own[s] / sum(own.values()) == pytest.approx(quota[s] / sum(quota.values()), abs=0.06)
    if mix.whole:
        copies = Counter(r["_id"] for r in found)
        assert len(copies) == 2000 and max(copies.values()) <= 4
        assert all(quota[s] >= total[s] for s in quota)


def test_chunks_do_not_matter(corpus):
    def rows(mix):
        prepared_rows, sources = weights_of(corpus, mix)
        found = schedule(prepared_rows, sources, mix)
        return sorted(map(tuple, found.select("_id", "epoch", "block", "slot").collect()))

    assert rows(Mix(rows_per_chunk=17)) == rows(Mix(rows_per_chunk=100_000)) == rows(Mix(broadcast_sources=0))


def test_mixed_agrees_with_schedule(corpus):
    mix = Mix(entropy=None, max_repeats=2.0)
    rows, sources = weights_of(corpus, mix)
    want = Counter(r["_id"] for r in schedule(rows, sources, mix).collect())
    got = mixed(corpus, mix)
    assert got.columns == corpus.columns
    assert Counter(r["doc_id"] for r in got.collect()) == want


def test_odd_rows(spark, result, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    words = re.compile(r"[^\x20\x09-\x0D]+")
    want = Counter((r["doc_id"], r["source"], len(words.findall(r["text"] or ""))) for r in docs.collect())
    rows = result("op2", odd_dir)
    got = {(r["doc_id"], r["source"], r["n_tokens"]) for r in rows}
    assert got <= set(want)
    assert (5, "b", 7) in got and Counter((r["doc_id"], r["epoch"]) for r in rows)[5, 0] in (0, 2)
    everything = mixed(docs, Mix(whole=True, entropy=None, max_repeats=2.0))
    assert everything.columns == docs.columns
    assert {(r["doc_id"], r["text"]) for r in everything.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect()}


def test_whole_reads_the_smallest_sources(spark):
    """Weights below half a billionth round to nothing; the documents are read all the same, and not too often."""
    mix = Mix(entropy=None, max_repeats=2.0, whole=True, block_tokens=10**9)
    sizes = {"huge": 5 * 10**12, "half": 10**12, "page": 300, "word": 1, "none": 0}
    rows = spark.createDataFrame(
        [(i, s, n, 1000 * i) for i, (s, n) in enumerate(sizes.items())],
        "_id bigint, _source string, _tokens bigint, _place bigint",
    )
    sources = weighted_sources(rows, mix)
    quota = {r["_source"]: r["quota"] for r in sources.collect()}
    assert quota["huge"] == sizes["huge"] and quota["none"] == 0
    assert all(sizes[s] <= quota[s] <= 2 * sizes[s] for s in sizes)
    read = Counter(r["_source"] for r in schedule(rows, sources, mix).collect())
    assert set(read) == set(sizes) and read["huge"] == 1 and max(read.values()) <= 2


def test_a_tiny_source_keeps_its_documents(spark):
    """5 tokens beside 3e10: its weight rounds to nothing in billionths, its budget doesn't."""
    rows = spark.createDataFrame(
        [("s1", "sbig", 3 * 10**10, 5), ("s2", "ssmall", 5, 7), ("s3", "snone", 0, 9)],
        "_id string, _source string, _tokens bigint, _place bigint",
    )
    for mix in (Mix(max_repeats=1.0), Mix(entropy=None, max_repeats=1.0), Mix(whole=True), Mix()):
        sources = weighted_sources(rows, mix)
        quotas = {r["_source"]: r["quota"] for r in sources.collect()}
        assert quotas["ssmall"] >= 5 and quotas["snone"] == 0
        got = {r["_id"] for r in schedule(rows, sources, mix).select("_id").distinct().collect()}
        assert got == {"s1", "s2", "s3"}


def test_documents_without_tokens_are_spread_over_the_blocks(spark):
    rows = [(i, "full", "a b c d e") for i in range(200)] + [(1000 + i, "none", "" if i % 2 else None) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    mix = Mix(entropy=None, max_repeats=None, block_tokens=100)
    prepared_rows = prepared(docs, "doc_id", "source", "text", mix).select("_id", "_source", "_tokens", "_place")
    plan = schedule(prepared_rows, weighted_sources(prepared_rows, mix), mix).filter("_tokens = 0").collect()
    assert len(plan) == 200
    blocks = Counter(r["block"] for r in plan)
    assert len(blocks) == 10 and max(blocks.values()) < 50


def test_other_columns_pass_whatever_their_names(spark):
    names = ["_id", "_source", "_tokens", "_place", "_total", "_full", "_last", "_copy", "_row", "quota", "weight"]
    docs = spark.createDataFrame(
        [(i, "a" if i % 3 else "b", f"w {i}", *[f"{n}{i}" for n in names]) for i in range(30)],
        "doc_id bigint, source string, text string, " + ", ".join(f"{n} string" for n in names),
    )
    out = mixed(docs, Mix(entropy=None, max_repeats=2.0, whole=True))
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in docs.collect()}
