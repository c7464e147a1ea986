from __future__ import annotations

import hashlib
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer, normalizers

from mercato.llm.bpe import encoder
from mercato.llm.op6_bpe import VOCABULARY, _groups, decode, encode, tokens

PATH = path(VOCABULARY)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def agrees(library, text):
    enc = encoder(PATH)
    want = library.encode(text, add_special_tokens=False).ids
    assert enc.encode(text) == want
    assert enc.vocab.decode(want).decode() == library.decode(want, skip_special_tokens=False)


HARD = [
    "", " ", "a", "<|startoftext|>hi<|endoftext|> x<|endoftext|", "Σίσυφος ΣΑΣ İstanbul ǅ Ⅷ ²³ ½ 日本語 🎉🎉",
    "it's we'LL don't 's'S 'RE", "\x1c\x1dA\u0085b​q z é ﬁ ẞ", "a" * 3000, "ab" * 2000, "ha" * 999 + "h",
    "\x00\x01﻿", "क्षि", "!!!???...", "1234567890", "the" * 500,
]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(library, text):
    agrees(library, text)


LETTERS = st.sampled_from(["a", "b", "e", "n", "the", "ing", " ", "'", "s", "1", "é", "é", "Σ", "İ", "\n", "!", "🎉", "<|endoftext|>", "日", " ", "\x1c"])


def test_every_character(library):
    """Whatever versions of Unicode the modules follow, in blocks with letters around."""
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "a".join(every[i : i + 64]) + "a: " + ":".join(every[i : i + 64]) for i in range(0, len(every), 64)]
    enc = encoder(PATH)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert enc.encode(text) == want.ids, hex(ord(text[1]))


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.lists(LETTERS, max_size=60).map("".join)))
def test_random_texts(library, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in text):
        return
    agrees(library, text)


def test_long_words_are_linear():
    enc = encoder(PATH)
    ids = enc.vocab.encode_word("ab" * 50_000)
    assert sum(enc.vocab.length[enc.vocab.ids.index(i)] for i in set(ids)) > 0


def test_whole_query(result, documents, library, odd_dir, spark):
    odd = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{odd_dir}/documents.parquet").collect()}
    for rows, texts in (
        (result("op6"), {i: r["text"] for i, r in documents.items()}),
        (result("op6", odd_dir), odd),
    ):
        for r in rows:
            want = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
            assert r["n_tokens"] == len(want)
            assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
            text = library.decode(want, skip_special_tokens=False)
            assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_encode_and_decode(spark, library):
    df = spark.createDataFrame([(1, "The quick brown fox"), (2, None)], "i int, text string")
    rows = {r["i"]: r for r in decode(encode(df)).collect()}
    assert rows[1]["ids"] == library.encode("The quick brown fox", add_special_tokens=False).ids
    assert rows[1]["decoded"] == "the</w> quick</w> brown</w> fox</w>"
    assert rows[2]["ids"] == [] and rows[2]["decoded"] == ""


def marks():
    """Combining characters by either version of Unicode: what moves when it stands beside a mark of another class."""
    compose = normalizers.NFC().normalize_str
    found = []
    for c in (chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000):
        if unicodedata.combining(c):
            found.append(c)
        elif any(compose(f"a{x}{y}") != f"a{x}{y}" for x, y in ((c, "̣"), ("́", c)) if ord(c) > 0x2FF):
            found.append(c)
    return found


def test_sequences_of_combining_characters(library):
    enc, found = encoder(PATH), marks()
    assert len(found) > 800
    texts = [f"a{x}{y}b" for c in found for m in ("̣", "́", "̕") for x, y in ((c, m), (m, c))]
    texts += ["á߽b", "a࢘̕b", "\U00011935\U00011930"]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert enc.encode(text) == want.ids, ascii(text)


def test_canonical_decompositions(library):
    enc = encoder(PATH)
    every = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    texts = [f"x{unicodedata.normalize('NFD', c)}{c}y" for c in every if unicodedata.normalize("NFD", c) != c]
    assert len(texts) > 10_000
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert enc.encode(text) == want.ids, ascii(text)


def test_columns_of_the_results_names_are_replaced(spark):
    df = spark.createDataFrame(
        [(1, "a b", 7, "x", "y", "v"), (2, None, 8, "x", "y", "v")],
        "i int, text string, N_TOKENS int, ids string, decoded string, value string",
    )
    rows = tokens(df).orderBy("i").collect()
    assert rows[0].asDict().keys() == {"i", "decoded", "value", "n_tokens", "ids_sha256", "decoded_sha256", "ids"}
    assert [(r["n_tokens"], len(r["ids"]), r["value"]) for r in rows] == [(2, 2, "v"), (0, 0, "v")]
    both = decode(encode(df)).orderBy("i").collect()
    assert both[0]["decoded"] == "a</w> b</w>" and both[0]["N_TOKENS"] == 7 and both[1]["ids"] == []


@pytest.mark.parametrize(
    "column",
    [
        pa.array(["x" * 700_000] * 5 + ["", None], pa.string()),
        pa.array([[1] * 200_000] * 5 + [None, []], pa.list_(pa.int32())),
        pa.array([], pa.string()),
    ],
)
def test_few_values_are_taken_at_a_time(column):
    groups = list(_groups(column))
    assert [i for g in groups for i in range(g.start, g.stop)] == list(range(len(column)))
    assert all(g.stop - g.start <= 4 for g in groups)
