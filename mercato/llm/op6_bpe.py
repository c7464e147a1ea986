"""BPE encoding and decoding of whole texts, each row on its own: no shuffle, nothing gathered.

Encoding is by backtracking over longest matches (see `bpe.py`), decoding by an offset table. The
vocabulary file is a parameter; it must exist on every machine. Its tables are built once per Python
worker and have a fixed size; words that were seen are kept up to a limit.

A NULL text is empty: no tokens, and the digests are those of the empty text. Texts may hold the
strings of special tokens, which become those tokens. Lone surrogates can't occur in Spark strings. New
columns replace columns of the same name. A task has about a megabyte of texts in Python at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.bpe import encoder
from mercato.llm.common import ddl, free_name, table
from mercato.llm.shingles import text_groups

VOCABULARY = "word_bpe_49k.json"
TOKENS_AT_ONCE = 250_000


def _mapped(docs: DataFrame, column: str, drop: bool, added: dict[str, str], make) -> DataFrame:
    """`docs` with the columns `added` (name to type), which replace others of their names.

    `make` gets some values of `column` at a time and returns the new columns' arrays.
    """
    names = {c.lower() for c in added}
    rest = [c for c in docs.columns if c.lower() not in names and not (drop and c == column)]
    value = free_name(docs, "value")
    source = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(f"`{column}`").alias(value))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for group in _groups(whole.column(value)):
                part = whole.slice(group.start, group.stop - group.start)
                arrays = make(part.column(value).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in rest), *arrays], names=[*rest, *added]
                )

    added_ddl = ", ".join(f"`{c}` {t}" for c, t in added.items())
    return source.mapInArrow(run, ddl(source.drop(value), added_ddl))


def _groups(column: pa.Array) -> Iterator[slice]:
    """Runs of about a megabyte: of texts by their bytes, of lists by their elements."""
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        yield from (group for group, _ in text_groups(column, lists=False))
        return
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(column):
        start = ends[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(ends, start + TOKENS_AT_ONCE)))
        yield slice(first, min(stop, len(column)))
        first = stop


def encode(docs: DataFrame, text: str = "text", path: str | None = None, to: str = "ids") -> DataFrame:
    """`docs` with the tokens of `text` as an array of int in column `to`."""
    path = path or tokenizer_path(VOCABULARY)

    def make(texts: list[str | None]) -> list[pa.Array]:
        encode_text = encoder(path).encode
        return [_lists([encode_text(t or "") for t in texts])]

    return _mapped(docs, text, False, {to: "array<int>"}, make)


def decode(docs: DataFrame, ids: str = "ids", path: str | None = None, to: str = "decoded") -> DataFrame:
    """`docs` with the text of the tokens in `ids` in column `to`."""
    path = path or tokenizer_path(VOCABULARY)

    def make(tokens: list[list[int] | None]) -> list[pa.Array]:
        vocab = encoder(path).vocab
        return [pa.array([vocab.decode(x or []).decode() for x in tokens], pa.string())]

    return _mapped(docs, ids, False, {to: "string"}, make)


def _lists(found: list[list[int]]) -> pa.Array:
    ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
    values = np.concatenate([np.array(x, dtype=np.int32) for x in found]) if found else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(values))


def tokens(docs: DataFrame, text: str = "text", path: str | None = None, with_ids: bool = True) -> DataFrame:
    """`docs` without `text`, with `n_tokens`, digests of the ids and of the decoded text, and the `ids`.

    Encoding and decoding in one pass, so that the tokens needn't leave the task to be decoded.
    """
    path = path or tokenizer_path(VOCABULARY)

    def make(texts: list[str | None]) -> list[pa.Array]:
        enc = encoder(path)
        vocab = enc.vocab
        counts, ids_digests, text_digests, kept = [], [], [], []
        for t in texts:
            ids = enc.encode(t or "")
            counts.append(len(ids))
            joined = " ".join(map(vocab.names.__getitem__, ids))
            ids_digests.append(hashlib.sha256(joined.encode()).hexdigest())
            text_digests.append(hashlib.sha256(vocab.decode(ids)).hexdigest())
            if with_ids:
                kept.append(np.array(ids, dtype=np.int32))
        arrays = [pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
        return [*arrays, _lists(kept)] if with_ids else arrays

    added = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    return _mapped(docs, text, True, added | ({"ids": "array<int>"} if with_ids else {}), make)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)
