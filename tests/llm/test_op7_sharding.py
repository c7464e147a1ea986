from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from mercato.llm.op7_sharding import Shard, Tree, even_tree, shard_of, with_slots

N = 6000


def placed(spark, tree):
    df = spark.range(N).select(F.col("id"), shard_of(F.col("id").cast("string"), tree).alias("shard"))
    return {r["id"]: r["shard"] for r in df.collect()}


def test_even(spark):
    count = Counter(placed(spark, even_tree(40)).values())
    assert set(count) == set(range(40))
    assert max(count.values()) < 1.5 * N / 40 and min(count.values()) > 0.6 * N / 40


@pytest.mark.parametrize("more", [1, 2, 3])
def test_growth_moves_rows_only_into_the_new_shard(spark, more):
    before, after = placed(spark, even_tree(40 + more - 1)), placed(spark, even_tree(40 + more))
    moved = Counter(after[i] for i in before if before[i] != after[i])
    assert set(moved) == {40 + more - 1}
    assert moved[40 + more - 1] == pytest.approx(N / (40 + more), rel=0.35)


def test_changed_weight_moves_rows_only_across_its_subtree(spark):
    tree = even_tree(16, base=16)
    heavy = Tree(tuple(Shard(s.shard, s.region, s.rack, 3.0 if s.shard == 5 else 1.0) for s in tree.shards))
    home = {s.shard: s for s in tree.shards}
    before, after = placed(spark, tree), placed(spark, heavy)
    grown = home[5]
    for i in before:
        if before[i] != after[i]:
            a, b = home[before[i]], home[after[i]]
            # Every move goes down into the part that got heavier, at the level where it leaves.
            assert b.region == grown.region
            if a.region == b.region:
                assert b.rack == grown.rack
                if a.rack == b.rack:
                    assert b.shard == 5
    assert Counter(after.values())[5] > 2 * Counter(before.values())[5]


def test_weights(spark):
    tree = Tree((Shard(0, "a", "a/x", 1.0), Shard(1, "a", "a/y", 2.0), Shard(2, "b", "b/x", 3.0)))
    count = Counter(placed(spark, tree).values())
    for shard, share in ((0, 1 / 6), (1, 2 / 6), (2, 3 / 6)):
        assert count[shard] / N == pytest.approx(share, abs=0.03)


def test_slots_and_digests(result, documents, odd_dir, spark):
    odd = spark.read.parquet(f"{odd_dir}/documents.parquet").collect()
    for rows, texts in (
        (result("op7"), Counter((i, r["text"]) for i, r in documents.items())),
        (result("op7", odd_dir), Counter((r["doc_id"], r["text"]) for r in odd)),
    ):
        slots = defaultdict(list)
        want = Counter()
        for (i, t), n in texts.items():
            data = (t or "").encode()
            want[i, len(data) + 16, zlib.crc32(data)] += n
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
        for r in rows:
            slots[r["shard"]].append(r["slot"])
            assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 40)
        for own in slots.values():
            assert sorted(own) == list(range(len(own)))


def test_chunks_do_not_matter(spark):
    rows = spark.range(500).select((F.col("id") % 400).alias("id"), (F.col("id") % 3).cast("int").alias("shard"))
    found = [sorted(map(tuple, with_slots(rows, ["id"], n).collect())) for n in (1, 10_000)]
    assert found[0] == found[1]
