from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from mercato.llm.components import components
from mercato.llm.op5_ngram_join import Join, common_counts, near_duplicates, one_of_each_class
from mercato.llm.shingles import bands_for


def grams(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """Per row (doc_id, text): class id, links, equal, from all pairs."""
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    near = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                near[i].append(j)
                near[j].append(i)
    root = list(range(n))
    for _ in range(n):
        new = [min([root[i], *(root[j] for j in near[i])]) for i in range(n)]
        if new == root:
            break
        root = new
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root[i]] = min(ids.get(root[i], doc_id), doc_id)
    return sorted(
        (str(rows[i][0]), str(ids.get(root[i])), len(near[i]), max(1, sum(bool(s) and s == sets[i] for s in sets)))
        for i in range(n)
    )


def got(df):
    return sorted(
        (str(r["doc_id"]), str(r["class_id"]), r["n_links"], r["n_equal"]) for r in df.collect()
    )


def near_copies(n, seed, words=60):
    """Copies of one text with a few words changed, so that not all pairs are linked."""
    rng = random.Random(seed)
    base = [f"w{seed}x{i}" for i in range(words)]
    out = []
    for k in range(n):
        own = list(base)
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(words)] = f"n{k}{rng.random()}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("block_rows", [5, 400])
@pytest.mark.parametrize("broadcast_ids", [0, 1000])
def test_groups_against_brute_force(spark, block_rows, broadcast_ids):
    texts = near_copies(60, 1) + near_copies(7, 2, 200) + near_copies(2, 3) + ["exact copy of a text " * 3] * 30
    texts += ["short", "short", "SHORT", "", None, "two words", "a b c d e", "a b c d e f"]
    rows = list(enumerate(texts)) + [(3, texts[70]), (5, texts[5]), (None, "short"), (None, "nothing like it at all")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    join = Join(block_rows=block_rows, broadcast_ids=broadcast_ids, recall=0.99999)
    assert got(near_duplicates(df, join)) == brute(rows)


def test_one_of_each_class(spark, odd_dir):
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet")
    kept = one_of_each_class(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    # 5, 6, 5 and 7 are copies; -13 and 13 too. Rows without words stay.
    assert ids == Counter([None, 1, 2, 3, 4, 5, 8, 9, 10, 11, 12, -13])


def test_same_id_two_texts(spark):
    rows = [(1, "one two three four five six"), (1, "seven eight nine ten eleven twelve"), (2, "one two three four five six")]
    kept = one_of_each_class(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted(r["text"] for r in kept) == sorted(t for _, t in rows[:2])


def test_odd_rows(result, odd_dir):
    rows = {r["doc_id"]: r for r in result("op5", odd_dir) if r["doc_id"] is not None}
    assert (rows[7]["class_id"], rows[7]["n_links"], rows[7]["n_equal"]) == (5, 3, 4)
    assert (rows[13]["class_id"], rows[13]["n_links"]) == (-13, 1)
    assert (rows[1]["class_id"], rows[1]["n_links"], rows[1]["n_grams"]) == (1, 0, 0)


def test_bands():
    for threshold in (0.5, 0.8, 0.9):
        for recall in (0.95, 0.999):
            bands, rows = bands_for(threshold, recall)
            assert 1 - (1 - threshold**rows) ** bands >= recall
    assert bands_for(0.8, 0.999) == (14, 4)


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert (common_counts(sets) == np.array(want)).all()


def test_components(spark):
    chain = [(f"{i:03}", f"{i + 1:03}") for i in range(60)] + [("x", "y"), ("z", "z"), ("y", "x"), ("p", "q"), ("q", "r")]
    found = dict(map(tuple, components(spark.createDataFrame(chain, "a string, b string")).collect()))
    assert {found[f"{i:03}"] for i in range(61)} == {"000"}
    assert found["x"] == found["y"] == "x" and found["r"] == "p" and "z" not in found


def test_a_third_of_the_rows_without_an_id(spark):
    """They are told apart by their texts, so none meets the others' texts."""
    rows = []
    for g in range(40):
        words = [f"w{g}x{i}" for i in range(40)]
        for copy in range(3):
            own = words[: 38 + copy]
            rows.append((None if copy == 0 or g % 5 == 0 else 100 * g + copy, " ".join(own)))
    rows += [(None, "one text of six plain words")] * 20 + [(7, None), (None, ""), (7, "lonely words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(near_duplicates(docs, Join(recall=0.99999))) == brute(rows)
    small = Join(recall=0.99999, block_grams=50)  # blocks by the sets' sizes
    assert got(near_duplicates(docs, small)) == brute(rows)


def test_other_columns_pass_whatever_their_names(spark):
    names = ["_doc", "_digest", "_row", "_name", "digest", "key", "class_id"]
    rows = [(i // 2, f"the same {i // 4} words for four of them", *[f"{n}{i}" for n in names]) for i in range(16)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    out = one_of_each_class(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [0, 2, 4, 6]
    assert {tuple(r) for r in out.collect()} <= set(rows)
