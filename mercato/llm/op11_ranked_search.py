"""Ranked lexical search of many items at once, with common subexpressions evaluated once.

1. Items are taken in blocks of at most `block_terms` terms (an item never spans blocks). One pass over
   the whole texts counts each document's terms and the block's terms in it; these short rows are stored.
   Sums over them give N, L and each term's df, and so the terms' weights.
2. Term sets that items share are mined: terms that occur in just the same items form one class, then the
   two classes (or sets found before) that most items have in common are joined, again and again. The
   result is a graph: every set is the sum of two others or of a class's terms, and every item the sum of
   few sets.
3. Another pass reads the stored rows. For some documents at a time, the sets' accumulators (one partial
   score per document) are worked out once each, in the order of the graph, and items add up theirs.
   A task keeps the best `k` documents of each item, so a document's scores are never shuffled.
4. The tasks' best are ranked per item.

Terms are the maximal runs of ASCII letters and digits (A to Z as a to z) and of all characters beyond
ASCII. A NULL text has none; a document without terms counts nowhere. Every row of the documents is a
document, so repeated rows are ranked one after the other. Equal scores are ranked by smaller id, NULL
ids last. Rows of the items that repeat an id and a text are one item; an id with several texts gives
the ranks of each. Items without terms, or whose terms no document holds, have no rows. All sums are exact.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import stored, table
from mercato.llm.shingles import text_groups

_PIECE = 1 << 20  # bytes of a long text that are split at a time

# A to Z become a to z; every other ASCII character that isn't a letter or a digit becomes a space.
_TERM_BYTES = bytes(
    b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


@dataclass(frozen=True)
class Ranking:
    k: int = 10
    block_items: int = 1000
    block_terms: int = 50_000
    # Sets are mined among so many classes of an item, those of most items. Sharing is less beyond it.
    mined_classes: int = 200
    # Bytes of accumulators that a task holds at a time.
    accumulator_bytes: int = 32_000_000


def terms_in(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, some at a time."""
    data = (text or "").encode().translate(_TERM_BYTES)
    start = 0
    while start < len(data):
        end = data.find(b" ", start + _PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


# ---- the graph of shared sets


@dataclass(frozen=True)
class Graph:
    """Sums to work out, in order. Rows 0 to `terms` - 1 are terms, the following ones the steps' results."""

    terms: int
    steps: tuple[tuple[tuple[int, int], ...], ...]  # per step: (row, times)
    items: tuple[int, ...]  # the row of each item

    @property
    def rows(self) -> int:
        return self.terms + len(self.steps)

    def evaluate(self, rows: np.ndarray) -> None:
        """Fill in all rows after the terms'."""
        for at, parts in enumerate(self.steps, self.terms):
            for row, times in parts:
                rows[at] += rows[row] if times == 1 else times * rows[row]


def shared_sets(items: list[Counter], terms: int, mined_classes: int) -> Graph:
    """A graph for items given as term numbers with their counts."""
    holders: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, item in enumerate(items):
        for part in sorted(item.items()):
            holders[part].append(i)
    classes: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
    for part, where in holders.items():
        classes[tuple(where)].append(part)

    steps: list[tuple[tuple[int, int], ...]] = []

    def add(parts: list[tuple[int, int]]) -> int:
        if len(parts) == 1 and parts[0][1] == 1:
            return parts[0][0]
        steps.append(tuple(parts))
        return terms + len(steps) - 1

    sums: list[set[int]] = [set() for _ in items]  # of each item: rows that add up to it
    used: dict[int, int] = {}
    for where, parts in classes.items():
        row = add(parts)
        used[row] = len(where)
        for i in where:
            sums[i].add(row)
    mined = [
        set(heapq.nsmallest(mined_classes, (r for r in own if used[r] > 1), key=lambda r: (-used[r], r)))
        for own in sums
    ]
    for i, own in enumerate(sums):
        own -= mined[i]

    together: Counter = Counter()
    of_row: dict[int, set[int]] = defaultdict(set)
    for i, own in enumerate(mined):
        for row in own:
            of_row[row].add(i)
        together.update(combinations(sorted(own), 2))
    heap = [(-n, pair) for pair, n in together.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        if together[a, b] != -n:  # its count has changed meanwhile
            if together[a, b] > 1:
                heapq.heappush(heap, (-together[a, b], (a, b)))
            continue
        row = add([(a, 1), (b, 1)])
        grown = set()
        for i in of_row[a] & of_row[b]:
            rest = mined[i] - {a, b}
            for other in rest:
                for old in (a, b):
                    together[min(old, other), max(old, other)] -= 1
                together[other, row] += 1
                grown.add(other)
            mined[i] = rest | {row}
            of_row[a].discard(i)
            of_row[b].discard(i)
            of_row[row].add(i)
        del together[a, b]
        for other in grown:
            if together[other, row] > 1:
                heapq.heappush(heap, (-together[other, row], (other, row)))
    rows = [add([(r, 1) for r in sorted(sums[i] | mined[i])]) if items[i] else -1 for i in range(len(items))]
    return Graph(terms, tuple(steps), tuple(rows))


# ---- passes


def _postings(vocabulary):
    """Documents to (doc_id, n, terms, counts): all their terms' number, and the block's terms in them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for part in parts:
            for group, texts in text_groups(part.column("text")):
                sizes, ends, terms, counts = [], [0], [], []
                for text in texts:
                    found: Counter = Counter()
                    n = 0
                    for piece in terms_in(text):
                        n += len(piece)
                        found.update(map(known.get, piece))
                    found.pop(None, None)
                    sizes.append(n)
                    terms += found.keys()
                    counts += found.values()
                    ends.append(len(terms))
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").slice(group.start, group.stop - group.start),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return run


def length_factors(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents with `n` terms, of all `documents` with `terms` altogether."""
    if 75 * int(n.max(initial=0)) * documents >= 2**63:
        return np.array([25 + 75 * int(x) * documents // terms for x in n], dtype=np.int64)
    return 25 + (75 * n * documents) // terms


class _Best:
    """The best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.items, self.k = items, k
        self.found = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]  # item, score, id, no id
        self.least = np.ones(items, np.int64)  # score from which on a document may be among the best

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        least = self.least
        if scores.shape[1] > self.k:
            at = scores.shape[1] - self.k
            least = np.maximum(least, np.partition(scores, at, axis=1)[:, at])
        item, doc = np.nonzero(scores >= least[:, None])
        fresh = [item, scores[item, doc], ids[doc], no_id[doc]]
        item, score, doc_id, missing = (np.concatenate(x) for x in zip(self.found, fresh, strict=True))
        order = np.lexsort((doc_id, missing, -score, item))
        first = np.searchsorted(item[order], np.arange(self.items))
        rank = np.arange(len(order)) - first[item[order]]
        order, rank = order[rank < self.k], rank[rank < self.k]
        self.found = [x[order] for x in (item, score, doc_id, missing)]
        last = rank == self.k - 1
        self.least[self.found[0][last]] = self.found[1][last]


SCORED = "item int, doc_id bigint, score bigint"


def _scored(shared, ranking: Ranking):
    """Postings to each item's best documents of the task."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights, documents, terms = shared.value
        rows_of_items = np.array(graph.items)
        best = _Best(len(rows_of_items), ranking.k)
        at_once = max(1, ranking.accumulator_bytes // (8 * graph.rows))
        for whole in parts:
            for start in range(0, len(whole), at_once):
                part = whole.slice(start, at_once)
                n = part.column("n").to_numpy()
                sizes = np.diff(part.column("terms").offsets.to_numpy())
                doc = np.repeat(np.arange(len(part)), sizes)
                term = part.column("terms").flatten().to_numpy()
                tf = part.column("counts").flatten().to_numpy()
                m = length_factors(n, documents, terms)
                rows = np.zeros((graph.rows, len(part)), dtype=np.int64)
                rows[term, doc] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
                graph.evaluate(rows)
                ids = part.column("doc_id")
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                best.add(rows[rows_of_items], ids.fill_null(0).to_numpy(), no_id)
        item, score, doc_id, no_id = best.found
        yield pa.RecordBatch.from_arrays(
            [pa.array(item.astype(np.int32)), pa.array(doc_id, mask=no_id), pa.array(score)],
            names=["item", "doc_id", "score"],
        )

    return run


def blocks(items: DataFrame, ranking: Ranking) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items with their terms' counts, in blocks of a bounded size; few are on the driver at a time."""
    block: list[tuple[int | None, Counter]] = []
    size = 0
    for row in items.select("item_id", "text").distinct().orderBy("item_id", "text").toLocalIterator():
        terms: Counter = Counter()
        for piece in terms_in(row["text"]):
            terms.update(piece)
        if not terms:
            continue
        if block and (len(block) == ranking.block_items or size + len(terms) > ranking.block_terms):
            yield block
            block, size = [], 0
        block.append((row["item_id"], terms))
        size += len(terms)
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, ranking: Ranking | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): the best of all `docs` (doc_id, text) for each of `items` (item_id, text)."""
    ranking = ranking or Ranking()
    results = [_block_results(docs, block, ranking) for block in blocks(items, ranking)]
    if not results:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    return found


def _block_results(docs: DataFrame, block: list[tuple[int | None, Counter]], ranking: Ranking) -> DataFrame:
    spark = docs.sparkSession
    context = spark.sparkContext
    numbers = {term: i for i, term in enumerate(sorted({t for _, terms in block for t in terms}))}
    vocabulary = context.broadcast(numbers)
    schema = "doc_id bigint, n bigint, terms array<int>, counts array<bigint>"
    postings = stored(docs.select("doc_id", "text").mapInArrow(_postings(vocabulary), schema), "postings")
    vocabulary.unpersist()

    documents, terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block.
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(numbers), dtype=np.int64)
    for row in df:
        weights[row["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["count"] + 1)))

    graph = shared_sets(
        [Counter({numbers[t]: n for t, n in terms.items()}) for _, terms in block], len(numbers), ranking.mined_classes
    )
    shared = context.broadcast((graph, weights, documents, terms))
    scored = postings.filter(F.size("terms") > 0).mapInArrow(_scored(shared, ranking), SCORED)
    place = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = scored.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= ranking.k)
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)], "item int, item_id bigint")
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sql_terms(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


ORACLE = f"""
  with d as (select row_number() over () rid, doc_id, {_sql_terms('text')} terms from documents),
    totals as (select count(*) filter (len(terms) > 0) documents, sum(len(terms))::bigint terms from d),
    tf as (select rid, term, count(*) tf from (select rid, unnest(terms) term from d) group by rid, term),
    w as (
      select term, floor(1000 * ln((2 * documents + 2)::double / (2 * count(*) + 1)))::bigint w
      from tf, totals group by term, documents),
    i as (select row_number() over () iid, item_id, {_sql_terms('text')} terms
      from (select distinct item_id, text from benchmark)),
    q as (select iid, term, count(*) q from (select iid, unnest(terms) term from i) group by iid, term),
    scored as (
      select iid, rid, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.terms) * documents) // totals.terms))))::bigint score
      from q join w using (term) join tf using (term) join d using (rid), totals group by iid, rid),
    ranked as (
      select iid, doc_id, score, row_number() over (partition by iid order by score desc, doc_id nulls last) rank
      from scored join d using (rid) where score > 0)
  select item_id, rank::int rank, doc_id, score from ranked join i using (iid) where rank <= 10
"""
