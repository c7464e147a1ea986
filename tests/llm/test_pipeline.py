"""The pipeline against its stages' meaning, worked out in Python."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from mercato.llm.bpe import encoder
from mercato.llm.op6_bpe import VOCABULARY
from public_tokenizers import path

SF_DIR = "/root/testdata/sf0.001"


def grams(text):
    w = text.encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def one_of_each(docs):
    ids = sorted(docs)
    sets = {i: grams(docs[i]) for i in ids}
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if len(a & b) >= 0.8 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i for i in ids if find(i) == i}


def test_stages_are_declared():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "mix_sources", "bpe"]


def test_whole_run(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    after = {}
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF_DIR)
        assert current.columns == docs.columns
        after[name] = Counter(r["doc_id"] for r in current.collect())
    clean = {i for i, r in documents.items() if any(c.isalpha() for c in r["text"])}
    assert set(after["language_id"]) == clean
    assert set(after["near_duplicates"]) == one_of_each({i: documents[i]["text"] for i in clean})
    assert set(after["near_duplicates"].values()) == {1}
    # Every document is read, and none more than twice plus a started pass.
    assert set(after["mix_sources"]) == set(after["near_duplicates"])
    assert set(after["mix_sources"].values()) <= {1, 2, 3}
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(r["doc_id"] for r in rows) == after["mix_sources"]
    enc = encoder(path(VOCABULARY))
    for r in rows:
        ids = enc.encode(documents[r["doc_id"]]["text"])
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_odd_and_empty_tables(spark, odd_dir, empty_dir):
    rows = corpus_pipeline.run(spark, odd_dir).collect()
    # Without letters: 1, 2, 3, 8. Copies: 6, 7 and one 5; 13 of -13.
    assert {r["doc_id"] for r in rows} == {None, 4, 5, 9, 10, 11, 12, -13}
    assert corpus_pipeline.run(spark, empty_dir).collect() == []


def test_table_without_languages(spark, tmp_path):
    texts = ["a clean text of a few words", "another text, wholly unlike it", "12345 !!!", None, "", "日本語"]
    rows = [(i, t, None, "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.language_id(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {0, 1, 5}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {0, 1, 5}


def test_extra_columns_of_any_name_pass(spark, odd_dir):
    names = ["_id", "_source", "_doc", "_digest", "_total", "_full", "_row", "_name", "lang_pred", "_lang_score", "key"]
    docs = spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, odd_dir)
        assert docs.columns == columns
    rows = docs.collect()
    assert {r["doc_id"] for r in rows} == {None, 4, 5, 9, 10, 11, 12, -13}
    for r in rows:
        assert all(r[name] == f"{i}:{r['doc_id'] if r['doc_id'] is not None else 'none'}" for i, name in enumerate(names))
