"""Language-model scores by a weighted backoff automaton.

Model: two-word sequences over single words. A state is a context: the start of a text, and each word
of the training texts. Its arcs are the words that followed it, with the discounted probability
(count - discount) / count of the context. A failure arc leads from it to the root with the
probability left over, normalised by what the root gives to all other words. The root has an arc for
each word, with probability (c + 0.1) / (N + 0.1 (V + 1)), known or not. All probabilities after a state
add up to 1. A text is scored in one pass from left to right that carries the state. `Fit.context_share`
and `Fit.least` prune rarer contexts and arcs; by default nothing is pruned.

At scale the automaton is as large as the corpus, so nothing gathers it. Documents are dealt into
chunks, and each chunk gets the part of the automaton that its words can reach:

1. One pass counts words and pairs of neighbouring tokens per chunk. Counts meet in buckets of their
   64-bit hashes. A row holds the sorted hashes of one chunk and bucket as bytes, so that a hash costs
   about 6 bytes in the shuffle; where buckets outnumber hashes, it is a row per hash.
2. A bucket adds up its words or pairs, and tells a chunk about those that training texts of other
   chunks hold too. All else a chunk counts itself. Of the chunks that hold a pair, one owns it.
3. A chunk with its documents scores all arcs. A token that fails only needs the weight of its state's
   failure arc, a sum over all pairs of the state. So each chunk sums the pairs that it owns by state,
   and names the states in which its texts failed. What it says is written once.
4. Sums and failures meet in buckets of the state's hash, and the weights go to the documents.

A chunk is a range of ids. Where one holds over twice `Fit.chunk_bytes` of text (ids that are NULL,
repeated or sparse, long texts), its rows are dealt to as many chunks as needed by a hash of id and
text; only rows that agree in both stay together. N and V aren't needed before the last step.

A NULL text is empty and has one token, the end. A NULL id counts as the empty text (and so as held
out). Rows that repeat are counted and scored each. Without training rows, N and V are 0 and every token
is unknown.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import id_remainder, stored, table
from mercato.llm.shingles import hash_words, mixed, text_groups

END = xxhash.xxh3_64_intdigest(b"\n")  # no word holds a line end
START = xxhash.xxh3_64_intdigest(b"\n\n")
MIX = np.uint64(0xA0761D6478BD642F)
ADDED = 0.1
BLOCK = 1_000_000  # tokens that are scored at a time
WORDS, PAIRS, STATS = 0, 1, 2  # kinds of counts
STATES, FAILS, DOCS = 0, 1, 3  # kinds of what a chunk says, beside STATS


@dataclass(frozen=True)
class Fit:
    context_share: float = 0.0  # of all training tokens that a word needs to be a state
    least: int = 1  # times that a pair needs to be an arc
    discount: float = 0.75
    docs_per_chunk: int = 8000
    chunk_bytes: int = 32_000_000  # of text
    bucket_bytes: int = 16_000_000  # of text per bucket of hashes
    buffered: int = 3_000_000  # tokens that a task counts at a time


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, number per text): the words of all texts, each text's with its end."""
    hashes, counts = hash_words(texts)
    last = np.cumsum(counts + 1) - 1
    token = np.empty(len(hashes) + len(texts), dtype=np.uint64)
    is_word = np.ones(len(token), dtype=bool)
    is_word[last] = False
    token[is_word] = hashes
    token[last] = END
    return token, counts + 1


def states_before(token: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The state in which each token is read: the token before, or the start."""
    before = np.roll(token, 1)
    before[np.cumsum(counts) - counts] = START
    return before


def arcs_of(token: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return _arc(states_before(token, counts), token)


def _arc(state: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(word + state * MIX)


@dataclass(frozen=True)
class Prepared:
    rows: DataFrame  # doc_id, text, held_out, chunk
    bucket_bits: int


def _sized(docs: DataFrame, held_out, fit: Fit) -> Prepared:
    chunks = max(1, math.ceil(docs.count() / fit.docs_per_chunk))
    block = F.coalesce(F.floor(F.col("doc_id") / fit.docs_per_chunk), F.lit(0))
    rows = docs.select("doc_id", "text", held_out.alias("held_out"), F.pmod(block, F.lit(chunks)).alias("chunk"))
    sizes = stored(rows.groupBy("chunk").agg(F.sum(F.octet_length("text")).alias("bytes")), "chunk_sizes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    bits = max(2, math.ceil(math.log2(max(1, total / fit.bucket_bytes))))
    # Two numbers for each 2 * chunk_bytes of the corpus at most, so 16 MB for 100 TB.
    large = sizes.filter(F.col("bytes") > 2 * fit.chunk_bytes)
    if not large.isEmpty():
        pieces = large.select("chunk", F.ceil(F.col("bytes") / fit.chunk_bytes).alias("pieces"))
        piece = F.coalesce(F.pmod(F.xxhash64("doc_id", "text"), F.col("pieces")), F.lit(0))
        rows = rows.join(F.broadcast(pieces), "chunk", "left").select(
            "doc_id", "text", "held_out", (F.col("chunk") + piece * chunks).alias("chunk")
        )
    return Prepared(rows, bits)


def prepared(docs: DataFrame, held_out, fit: Fit) -> DataFrame:
    """(doc_id, text, held_out, chunk): neighbouring ids share a chunk."""
    return _sized(docs, held_out, fit).rows


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, each in as few bytes as the largest needs."""
    largest = int(numbers.max(initial=0))
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if largest <= np.iinfo(t).max)
    return numbers.astype(kind).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"<u{len(data) // n}").astype(np.int64)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes: the first, then the number of bytes that steps take, then the steps."""
    steps = np.diff(keys)
    width = max(1, (int(steps.max(initial=0)).bit_length() + 7) // 8)
    return keys[:1].tobytes() + bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked_keys(data: bytes) -> np.ndarray:
    width = data[8]
    steps = np.frombuffer(data, dtype=np.uint8, offset=9).reshape(-1, width)
    keys = np.zeros((len(steps) + 1, 8), dtype=np.uint8)
    keys[1:, :width] = steps
    keys = keys.view(np.uint64).ravel()
    keys[0] = np.frombuffer(data, dtype=np.uint64, count=1)[0]
    return np.cumsum(keys, dtype=np.uint64)


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    changes = [c[1:] != c[:-1] for c in columns]
    return np.flatnonzero(np.concatenate(([True], np.logical_or.reduce(changes))))


def _slices(starts: np.ndarray, size: int) -> Iterator[slice]:
    return (slice(a, b) for a, b in zip(starts, np.append(starts, size)[1:], strict=True))


def _buckets(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}


def _batch(schema: str, rows: list[dict]) -> pa.RecordBatch:
    """A batch of rows that name only some of the columns."""
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(name) for r in rows], _ARROW[kind]) for name, kind in fields], names=_names(schema)
    )


COUNTS = "kind int, bucket bigint, chunk bigint, keys binary, n binary"


def _counted(fit: Fit, bits: int):
    """Documents to the number of times that training rows of a chunk hold each of its words and pairs."""

    def reduced(kind: int, key: np.ndarray, chunks: np.ndarray, chunk: np.ndarray, train: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(key)
        if len(chunks) > 1:
            order = order[np.argsort(chunk[order], kind="stable")]
        key, chunk = key[order], chunk[order]
        first = _runs(key, chunk)
        n = np.add.reduceat(train[order], first, dtype=np.int64)
        key, chunk = key[first], chunk[first]
        bucket = _buckets(key, bits)
        return _batch(
            COUNTS,
            [
                {
                    "kind": kind,
                    "bucket": int(bucket[s.start]),
                    "chunk": int(chunks[chunk[s.start]]),
                    "keys": _packed_keys(key[s]),
                    "n": _packed(n[s]),
                }
                for s in _slices(_runs(bucket, chunk), len(bucket))
            ],
        )

    def counts(buffer: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        word, n, chunk, train = (np.concatenate(x) for x in zip(*buffer, strict=True))
        buffer.clear()
        chunks, chunk = np.unique(chunk, return_inverse=True)
        chunk, train = np.repeat(chunk.astype(np.int32), n), np.repeat(train, n)
        yield reduced(WORDS, word, chunks, chunk, train)
        word = arcs_of(word, n)
        yield reduced(PAIRS, word, chunks, chunk, train)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer: list[tuple[np.ndarray, ...]] = []
        size = 0
        for part in parts:
            chunks = part.column("chunk").to_numpy()
            train = ~part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for group, texts in text_groups(part.column("text")):
                word, n = tokens(texts)
                buffer.append((word, n, chunks[group], train[group]))
                size += len(word)
                if size >= fit.buffered:
                    yield from counts(buffer)
                    size = 0
        if size:
            yield from counts(buffer)

    return run


TOLD = "chunk bigint, kind int, keys binary, totals binary, docs binary, n bigint, v bigint"


def _dealt(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents on their way to their chunk, about a megabyte of texts in a compressed block."""
    for part in parts:
        for group, _ in text_groups(part.column("text"), lists=False):
            rows = part.slice(group.start, group.stop - group.start)
            chunk = rows.column("chunk").to_numpy()
            if (chunk != chunk[0]).any():
                rows = rows.take(pa.array(np.argsort(chunk, kind="stable")))
                chunk = rows.column("chunk").to_numpy()
            docs = rows.select(["doc_id", "held_out", "text"])
            yield _batch(
                TOLD,
                [
                    {"chunk": int(chunk[s.start]), "kind": DOCS, "docs": _written(docs.slice(s.start, s.stop - s.start))}
                    for s in _slices(_runs(chunk), len(chunk))
                ],
            )


def _written(docs: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(docs)
    return sink.getvalue().to_pybytes()


def _totals(counts: pa.Table) -> pa.Table:
    """A bucket's counts to totals for the chunks, which don't know them: twice the total, and 1 for the pair's owner."""
    kind = counts.column("kind")[0].as_py()
    by_chunk = counts.sort_by("chunk")
    found = [_unpacked_keys(k) for k in by_chunk.column("keys").to_pylist()]
    sizes = [len(k) for k in found]
    key = np.concatenate(found)
    chunk = np.repeat(by_chunk.column("chunk").to_numpy(), sizes)
    n = np.concatenate([_unpacked(x, size) for x, size in zip(by_chunk.column("n").to_pylist(), sizes, strict=True)])
    order = np.argsort(key, kind="stable")
    key, chunk, n = key[order], chunk[order], n[order]
    first = _runs(key, chunk)
    key, chunk, own = key[first], chunk[first], np.add.reduceat(n, first)
    keys = _runs(key)
    by_key = np.add.reduceat(own, keys)
    number = np.repeat(np.arange(len(keys)), np.diff(np.append(keys, len(key))))
    total = by_key[number]
    owner = np.zeros(len(key), dtype=np.int64)
    trained = np.flatnonzero(own > 0)
    owner[trained[_runs(number[trained])]] = 1
    told = np.flatnonzero(total != own)
    told = told[np.argsort(chunk[told], kind="stable")]
    key, chunk, total = key[told], chunk[told], 2 * total[told] + owner[told]
    rows = [
        {"chunk": int(chunk[s.start]), "kind": kind, "keys": _packed_keys(key[s]), "totals": _packed(total[s])}
        for s in _slices(_runs(chunk), len(chunk))
    ]
    if kind == WORDS:
        rows.append({"chunk": -1, "kind": STATS, "n": int(by_key.sum()), "v": int((by_key > 0).sum())})
    return pa.Table.from_batches([_batch(TOLD, rows)])


SAID = (
    "kind int, bucket bigint, chunk bigint, keys binary, arcs binary, followed binary, missing binary, root binary,"
    " row binary, number bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, n_root bigint,"
    " base double, score double, n bigint, v bigint"
)


class Chunk:
    """Documents of a chunk, and what it is told about their words and pairs."""

    def __init__(self, number: int, least_context: float, fit: Fit, bits: int):
        self.number, self.least_context, self.fit, self.bits = number, least_context, fit, bits
        self.told: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {WORDS: [], PAIRS: []}
        self.docs: list[tuple[np.ndarray, ...]] = []
        self.ids: list[pa.RecordBatch] = []

    def tell(self, kind: int, keys: bytes, totals: bytes) -> None:
        found = _unpacked_keys(keys)
        self.told[kind].append((found, _unpacked(totals, len(found))))

    def add(self, docs: pa.RecordBatch) -> None:
        self.ids.append(docs.select(["doc_id", "held_out"]))
        for _, texts in text_groups(docs.column("text")):
            self.docs.append(tokens(texts))

    def _known(self, kind: int, key: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct keys, a place of each, their totals, whether the chunk owns them, and each token's number among them."""
        order = np.argsort(key)
        key = key[order]
        first = _runs(key)
        keys, place = key[first], order[first]
        total = np.add.reduceat(train[order], first, dtype=np.int64)
        same = np.zeros(len(key), dtype=np.int32)
        same[first[1:]] = 1
        number = np.empty(len(key), dtype=np.int32)
        number[order] = np.cumsum(same, dtype=np.int32)
        owned = total > 0
        for told, value in self.told[kind]:
            at = np.searchsorted(keys, told)
            total[at], owned[at] = value >> 1, (value & 1).astype(bool)
        self.told[kind] = []
        return keys, place, total, owned, number

    def said(self) -> Iterator[pa.RecordBatch]:
        if not self.docs:
            return
        word, counts = (np.concatenate(x) for x in zip(*self.docs, strict=True))
        self.docs = []
        ids = pa.Table.from_batches(self.ids)
        train = np.repeat(~ids.column("held_out").to_numpy().astype(bool), counts)
        words, _, word_total, _, word_number = self._known(WORDS, word, train)
        starts = word_total[np.searchsorted(words, np.uint64(END))]  # each training text has one end
        del words
        _, place, total, owned, number = self._known(PAIRS, arcs_of(word, counts), train)
        place, own_total = place[owned], total[owned]
        before = states_before(word, counts)
        del word
        yield from self._states(before[place], own_total, word_total[word_number[place]])
        del place, own_total
        ends = np.cumsum(counts)
        failed = []
        at = 0
        while at < len(counts):  # some documents at a time
            stop = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, side="right")))
            own = slice(ends[at] - counts[at], ends[stop - 1])
            found, fails = self._scores(word_total[word_number[own]], total[number[own]], counts[at:stop], starts)
            yield self._documents(at, ids.slice(at, stop - at), counts[at:stop], *found)
            row = np.repeat(np.arange(at, stop), counts[at:stop])
            failed.append((before[own][fails], row[fails]))
            at = stop
        yield from self._failures(*(np.concatenate(x) for x in zip(*failed, strict=True)))

    def _scores(self, count: np.ndarray, pair: np.ndarray, counts: np.ndarray, starts: int):
        """Per document: known tokens, tokens read at the root, sums of log10 weights; and the tokens that fail."""
        first = np.cumsum(counts) - counts
        # The token before is a word of the same text, but at the start.
        context = np.roll(count, 1)
        context[first] = starts
        is_state = (context > 0) & (context >= self.least_context)
        is_state[first] = starts > 0
        is_arc = is_state & (pair >= max(1, self.fit.least))
        by_word = np.log10(count + ADDED)
        weight = by_word.copy()
        weight[is_arc] = np.log10((pair[is_arc] - self.fit.discount) / context[is_arc])
        sums = [np.add.reduceat(x.astype(np.int64), first) for x in (count > 0, ~is_arc)]
        return [*sums, np.add.reduceat(by_word, first), np.add.reduceat(weight, first)], np.flatnonzero(is_state & ~is_arc)

    def _documents(self, start: int, ids: pa.Table, counts, known, root, base, score) -> pa.RecordBatch:
        columns = {
            "kind": pa.array(np.full(len(counts), DOCS), pa.int32()),
            "chunk": pa.array(np.full(len(counts), self.number), pa.int64()),
            "number": pa.array(np.arange(start, start + len(counts)), pa.int64()),
            "doc_id": ids.column("doc_id").combine_chunks().cast(pa.int64()),
            "held_out": ids.column("held_out").combine_chunks(),
            "n_tokens": pa.array(counts, pa.int64()),
            "n_known": pa.array(known, pa.int64()),
            "n_root": pa.array(root, pa.int64()),
            "base": pa.array(base, pa.float64()),
            "score": pa.array(score, pa.float64()),
        }
        fields = [x.split() for x in SAID.split(", ")]
        return pa.RecordBatch.from_arrays(
            [columns.get(name, pa.nulls(len(counts), _ARROW[kind])) for name, kind in fields], names=_names(SAID)
        )

    def _states(self, state: np.ndarray, total: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Sums over the chunk's own pairs by state: arcs, their totals, other pairs' totals, their words' counts."""
        order = np.argsort(state)
        state, total, count = state[order], total[order], count[order]
        arc = total >= self.fit.least
        first = _runs(state)
        if not len(first):
            return
        sums = [
            np.add.reduceat(x, first)
            for x in (arc.astype(np.int64), np.where(arc, total, 0), np.where(arc, 0, total), np.where(arc, count, 0))
        ]
        yield from self._blobs(STATES, state[first], dict(zip(SUMS, sums, strict=True)))

    def _failures(self, state: np.ndarray, row: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(state)
        yield from self._blobs(FAILS, state[order], {"row": row[order]})

    def _blobs(self, kind: int, keys: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        bucket = _buckets(keys, self.bits)
        yield _batch(
            SAID,
            [
                {
                    "kind": kind,
                    "bucket": int(bucket[s.start]),
                    "chunk": self.number,
                    "keys": _packed_keys(keys[s]),
                    **{name: _packed(x[s]) for name, x in columns.items()},
                }
                for s in _slices(_runs(bucket), len(bucket))
            ],
        )


SUMS = ("arcs", "followed", "missing", "root")


def _said(least_context: float, fit: Fit, bits: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = None
        for batch in parts:
            numbers = batch.column("chunk").to_numpy()
            kinds = batch.column("kind").to_numpy()
            for s in _slices(_runs(numbers, kinds), len(batch)):
                if chunk is None or numbers[s.start] != chunk.number:
                    if chunk is not None:
                        yield from chunk.said()
                    chunk = Chunk(int(numbers[s.start]), least_context, fit, bits)
                rows = batch.slice(s.start, s.stop - s.start)
                if kinds[s.start] == STATS:
                    n, v = (int(rows.column(c).to_numpy().sum()) for c in ("n", "v"))
                    yield _batch(SAID, [{"kind": STATS, "n": n, "v": v}])
                elif kinds[s.start] == DOCS:
                    for docs in rows.column("docs"):
                        for own in pa.ipc.open_stream(docs.as_buffer()):
                            chunk.add(own)
                else:
                    for keys, totals in zip(rows.column("keys"), rows.column("totals"), strict=True):
                        chunk.tell(int(kinds[s.start]), keys.as_py(), totals.as_py())
        if chunk is not None:
            yield from chunk.said()

    return run


FAILURES = "chunk bigint, number bigint, failure double"


def _failure_weights(divisor: float, fit: Fit) -> Callable[[pa.Table], pa.Table]:
    """A bucket's states and failures to the sum of log10 weights of a document's failure arcs into the bucket."""

    def run(said: pa.Table) -> pa.Table:
        kinds = said.column("kind").to_numpy()
        states, fails = said.filter(pa.array(kinds == STATES)), said.filter(pa.array(kinds == FAILS))
        out = []
        keys, weight = _weights(states, divisor, fit)
        for chunk, key, row in zip(*(fails.column(c).to_pylist() for c in ("chunk", "keys", "row")), strict=True):
            state = _unpacked_keys(key)
            number = _unpacked(row, len(state))
            at = np.minimum(np.searchsorted(keys, state), max(0, len(keys) - 1))
            own = np.where(keys[at] == state, weight[at], 0.0) if len(keys) else np.zeros(len(state))
            rows, place = np.unique(number, return_inverse=True)
            columns = [pa.array(np.full(len(rows), chunk)), pa.array(rows), pa.array(np.bincount(place, weights=own))]
            out.append(pa.RecordBatch.from_arrays(columns, names=_names(FAILURES)))
        return pa.Table.from_batches([*out, _batch(FAILURES, [])])

    return run


def _weights(states: pa.Table, divisor: float, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of states, and the log10 weights of their failure arcs."""
    found = [_unpacked_keys(k) for k in states.column("keys").to_pylist()]
    key = np.concatenate([np.zeros(0, np.uint64), *found])
    keys, number = np.unique(key, return_inverse=True)
    arcs, followed, missing, root = (np.zeros(len(keys), dtype=np.int64) for _ in SUMS)
    for total, name in zip((arcs, followed, missing, root), SUMS, strict=True):
        parts = [_unpacked(x, len(k)) for x, k in zip(states.column(name).to_pylist(), found, strict=True)]
        np.add.at(total, number, np.concatenate([np.zeros(0, np.int64), *parts]))
    left = (missing + fit.discount * arcs) / np.maximum(followed + missing, 1)
    others = (divisor - root - ADDED * arcs) / divisor
    weight = np.log10(np.maximum(left, 1e-12)) - np.log10(np.maximum(others, 1e-12))
    return keys, np.where(arcs > 0, weight, 0.0)


def _train_tokens(rows: DataFrame) -> int:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, texts in text_groups(part.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array([len(tokens(texts)[0])], pa.int64())], names=["n"])

    return rows.filter("not held_out").select("text").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


@dataclass(frozen=True)
class Gathered:
    """A whole model in one place."""

    train_tokens: int
    vocabulary: int
    states: np.ndarray  # sorted hashes
    counts: np.ndarray  # of the contexts


def train(rows: DataFrame, fit: Fit) -> tuple[Gathered, DataFrame]:
    """A small model to look at, its states numbered, and (state, word, total), -1 being the root. Scoring never gathers it."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for _, texts in text_groups(part.column("text")):
                word, counts = tokens(texts)
                both = states_before(word, counts), word
                yield pa.RecordBatch.from_arrays([pa.array(_signed(x)) for x in both], names=["state", "word"])

    seen = rows.filter("not held_out").select("text").mapInArrow(run, "state bigint, word bigint")
    pairs = stored(seen.groupBy("state", "word").agg(F.count("*").alias("total")), "pairs")
    words = pairs.groupBy("word").agg(F.sum("total").alias("total"))
    n, v = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count("*")).first()
    contexts = pairs.groupBy("state").agg(F.sum("total").alias("context"))
    start = int(_signed(np.array([START], dtype=np.uint64))[0])
    found = contexts.filter((F.col("state") == start) | (F.col("context") >= max(1.0, fit.context_share * n))).toArrow()
    states = found.column("state").to_numpy().view(np.uint64)
    order = np.argsort(states)
    numbers = rows.sparkSession.createDataFrame(
        [(int(s), i) for i, s in enumerate(_signed(states[order]))], "state bigint, number int"
    )
    arcs = words.select(F.lit(-1).alias("state"), "word", "total").unionByName(
        pairs.filter(F.col("total") >= fit.least)
        .join(numbers, "state")
        .select(F.col("number").alias("state"), "word", "total")
    )
    return Gathered(n, v, states[order], found.column("context").to_numpy()[order]), arcs


def score(docs: DataFrame, held_out, fit: Fit | None = None) -> DataFrame:
    """Scores of each row of `docs` (doc_id, text) by a model of the rows that aren't `held_out`."""
    fit = fit or Fit()
    sized = _sized(docs, held_out, fit)
    rows, bits = sized.rows, sized.bucket_bits
    least_context = fit.context_share * _train_tokens(rows) if fit.context_share else 0.0
    counts = rows.mapInArrow(_counted(fit, bits), COUNTS)
    told = counts.groupBy("kind", "bucket").applyInArrow(_totals, TOLD)
    together = (
        told.unionByName(rows.mapInArrow(_dealt, TOLD))
        .repartition("chunk")
        .sortWithinPartitions("chunk", "kind")
    )
    said = stored(together.mapInArrow(_said(least_context, fit, bits), SAID), "said")
    n, v = (x or 0 for x in said.filter(F.col("kind") == STATS).agg(F.sum("n"), F.sum("v")).first())
    divisor = n + ADDED * (v + 1)
    failures = (
        said.filter(F.col("kind").isin(STATES, FAILS))
        .select("kind", "bucket", "chunk", "keys", *SUMS, "row")
        .groupBy("bucket")
        .applyInArrow(_failure_weights(divisor, fit), FAILURES)
        .groupBy("chunk", "number")
        .agg(F.sum("failure").alias("failure"))
    )
    root = F.lit(math.log10(divisor))
    return (
        said.filter(F.col("kind") == DOCS)
        .join(failures, ["chunk", "number"], "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(n).cast("bigint").alias("train_tokens"),
            (F.col("base") - F.col("n_tokens") * root).alias("base_score"),
            (F.col("score") - F.col("n_root") * root + F.coalesce("failure", F.lit(0.0))).alias("score"),
        )
    )


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, id_remainder("doc_id", 10) == 0)
