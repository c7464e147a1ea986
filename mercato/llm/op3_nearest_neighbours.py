"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Vectors are scaled to length 1, where the nearest by cosine are the nearest by distance. Each of
`tables` hash tables has `dims` random projections, cut into slots of `width`; the slots' numbers
name a bucket. A query visits buckets in order of the estimated chance that a neighbour at a certain
cosine lies in them, until the chances of a table add up to `reach`. It does so for the fitted cosine,
which nearly all queries' neighbours exceed, and for nearer ones, at half the angle each time, as near
copies lie in other buckets than far neighbours do. Candidates of all visited buckets are ranked by
their exact cosine, and the tables' results are merged.

The buckets that a query visits are those whose cost, a sum of one cost for each slot, is at most a limit. So a
query is sent with its limits (`Index.limits`), and not with a row for each of its buckets, of which there
are thousands where vectors are many.

* Equal vectors are indexed once with their `k + 1` smallest ids, which is all that a result can
  hold of them, and are asked for once. So a vector that a third of the rows share costs one row.
* Buckets are dealt to chunks, as many as there are cores unless that makes more than `chunk_numbers` numbers
  or less than `chunk_rows` rows of each. Large buckets are dealt to several. Each chunk meets the queries on
  its own, block by block. A task keeps one chunk and the best rows of the queries it has seen, up to a limit.
* Limits are found on sorted sums of the costs of half the projections each, so neither time nor memory follows the number of
  visited buckets.
* The cosine of a query's last neighbour is fitted on a bounded sample (`sample_rows`,
  `sample_queries`) as a low quantile over its queries, so that groups of near copies don't hide vectors
  that stand alone; every row is indexed. The number of projections follows from the number of rows, so that buckets stay small.

Rows with a NULL id, and vectors that are NULL, empty, all zero, or hold NULL or non-finite
components take no part, nor do vectors of another length than the most frequent one (of equally
frequent ones, the shorter). Rows that repeat an id and a vector count once; a row with the
query's own id is never its neighbour. Equal scores are ranked by smaller id.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import salted_lookup, stored, table

INDEXED, ASKED = 0, 1


@dataclass(frozen=True)
class Search:
    k: int = 5
    tables: int = 2
    width: float = 1.5
    reach: float = 0.78
    bucket_rows: int = 128
    chunk_rows: int = 4096
    chunk_numbers: int = 4_000_000  # rows times components
    block: int = 512  # queries that meet a chunk at once
    probing_tasks: int = 0  # that work out the buckets of queries; 0: as many as the cluster has cores
    sample_rows: int = 20_000
    sample_queries: int = 200
    sample_numbers: int = 4_000_000  # rows times components
    quantile: float = 0.02  # of the queries' last neighbours
    nearest_angle: float = 0.2  # radians, to which nearer neighbours are probed for
    seed: int = 7


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by a power of two, so that squares don't overflow."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0.0))
    scaled = np.ldexp(vectors, -exponent[:, None])
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, whatever other rows are in the block."""
    a = np.ldexp(a, -np.frexp(np.abs(a).max(axis=1, initial=0.0))[1][:, None])
    b = np.ldexp(b, -np.frexp(np.abs(b).max(axis=1, initial=0.0))[1][:, None])
    dot, aa, bb = (np.einsum("ij,ij->i", x, y) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


@dataclass(frozen=True)
class Index:
    """The hash functions, and the cosine of the farthest neighbours that probing looks for."""

    search: Search
    size: int
    dims: int
    cosine: float

    def functions(self, number: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.search.seed, number])
        projections = rng.standard_normal((self.size, self.dims))
        offsets = rng.uniform(0, self.search.width, self.dims)
        mixers = rng.integers(1, 2**62, self.dims) * 2 + 1
        return projections, offsets, mixers

    def slots(self, vectors: np.ndarray, number: int) -> np.ndarray:
        """The slot of each (unit) vector on each projection."""
        projections, offsets, _ = self.functions(number)
        return np.floor((vectors @ projections + offsets) / self.search.width).astype(np.int64)

    def buckets(self, vectors: np.ndarray, number: int) -> np.ndarray:
        """The bucket of each (unit) vector."""
        return (self.slots(vectors, number) * self.functions(number)[2]).sum(axis=1)  # wraps around, as a hash may

    def probed_cosines(self) -> list[float]:
        """The fitted cosine, and those of half the angle each time."""
        found, angle = [self.cosine], math.acos(self.cosine) / 2
        while angle > self.search.nearest_angle / 2:
            found.append(math.cos(angle))
            angle /= 2
        return found

    def visits(self, vector: np.ndarray, number: int) -> list[int]:
        """The buckets that a (unit) vector asks."""
        return list(dict.fromkeys(b for c in self.probed_cosines() for b in self.probes(vector, number, c)))

    def costs(self, vectors: np.ndarray, number: int, cosine: float) -> tuple[int, np.ndarray]:
        """A first slot, and by (unit) vector, projection and slot from there on: -log of the estimated chance
        that a neighbour lies in the slot, infinite where it is next to none.
        """
        projections, offsets, _ = self.functions(number)
        width, spread = self.search.width, math.sqrt(max(1e-9, 1 - cosine**2))
        # A neighbour's projection is normal around cosine times the vector's own.
        centres = cosine * (vectors @ projections)
        low = np.floor((centres - 6 * spread + offsets) / width).astype(np.int64)
        high = np.floor((centres + 6 * spread + offsets) / width).astype(np.int64)
        first = int(low.min(initial=0))
        slots = np.arange(first, int(high.max(initial=0)) + 2)
        edges = ((slots * width - offsets[:, None]) - centres[:, :, None]) / (spread * math.sqrt(2))
        below = _erf(edges)
        chances = (below[:, :, 1:] - below[:, :, :-1]) / 2
        inside = (slots[:-1] >= low[:, :, None]) & (slots[:-1] <= high[:, :, None]) & (chances > 1e-12)
        return first, np.where(inside, -np.log(np.where(inside, chances, 1.0)), np.inf)

    def limits(self, vectors: np.ndarray, number: int) -> np.ndarray:
        """By (unit) vector and probed cosine: the highest cost of a bucket that it visits."""
        found = [
            [_limit(c, self.search.reach) for c in self.costs(vectors, number, cosine)[1]]
            for cosine in self.probed_cosines()
        ]
        return np.array(found).T.reshape(len(vectors), -1)

    def probes(self, vector: np.ndarray, number: int, cosine: float | None = None) -> Iterator[int]:
        """Buckets in falling order of the estimated chance to hold a neighbour of a (unit) vector."""
        _, _, mixers = self.functions(number)
        first, costs = self.costs(vector[None, :], number, self.cosine if cosine is None else cosine)
        limit = _limit(costs[0], self.search.reach)
        # By projection, the sums and hashes of the slots so far that can still stay below the limit.
        left = np.cumsum(costs[0].min(axis=1)[::-1])[::-1]
        sums, hashes = np.zeros(1), np.zeros(1, dtype=np.int64)
        for i, own in enumerate(costs[0]):
            rest = left[i + 1] if i + 1 < len(left) else 0.0
            sums = sums[:, None] + own
            hashes = hashes[:, None] + (first + np.arange(len(own))) * mixers[i]
            fits = np.isfinite(sums) & (sums + rest <= limit + 1e-9)
            sums, hashes = sums[fits], hashes[fits]
        yield from map(int, hashes[np.argsort(sums, kind="stable")])


def _erf(x: np.ndarray) -> np.ndarray:
    return np.fromiter(map(math.erf, x.ravel().tolist()), dtype=np.float64, count=x.size).reshape(x.shape)


def _sums(costs: np.ndarray, most: float) -> np.ndarray:
    """All sums of one cost of each row that are at most `most`, in rising order."""
    least = costs.min(axis=1)
    found, rest = np.zeros(1), least.sum()
    for own, low in zip(costs, least, strict=True):
        rest -= low
        found = (found[:, None] + own[np.isfinite(own)]).ravel()
        found = found[found + rest <= most + 1e-9]
    return np.sort(found)


def _limit(costs: np.ndarray, reach: float) -> float:
    """The cost up to which buckets' chances add up to `reach`, with all of equal cost; infinite if all don't reach it."""
    half = len(costs) // 2
    least = costs.min(axis=1)
    start, end = least.sum(), np.where(np.isfinite(costs), costs, 0).max(axis=1).sum()
    most = start
    while True:
        # The sums of either half up to `most` tell the chances of all buckets up to it.
        low, most = most, min(most + 4.0, end)
        one = _sums(costs[:half], most - least[half:].sum())
        two = _sums(costs[half:], most - least[:half].sum())
        chance, added = np.exp(-one), np.r_[0.0, np.cumsum(np.exp(-two))]

        def reached(limit: float) -> bool:
            return chance @ added[np.searchsorted(two, limit - one, "right")] >= reach

        if reached(most + 1e-9):
            break
        if most >= end:
            return math.inf
    if reached(low + 1e-9):
        return low + 1e-9
    while most - low > 1e-9:
        middle = (low + most) / 2
        low, most = (low, middle) if reached(middle) else (middle, most)
    return most + 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame, kind: str) -> DataFrame:
    """(vec_id, vec, _class) of rows that take part; equal vectors have equal classes."""
    return (
        vectors.select("vec_id", F.col("vec").cast(kind).alias("vec"))
        .filter("vec_id is not null and vec is not null")
        .filter(F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
        .filter(F.exists("vec", lambda x: x != 0))
        .withColumn("_class", F.concat_ws(":", F.xxhash64("vec"), F.xxhash64(F.lit("class"), "vec")))
    )


def fitted_cosine(sample: np.ndarray, search: Search) -> float:
    """The cosine that few queries' k-th neighbours fall short of, within a sample of (unit) vectors."""
    near = sample[: search.sample_queries] @ sample.T
    near[np.arange(len(near)), np.arange(len(near))] = -2
    last = -np.partition(-near, search.k - 1, axis=1)[:, search.k - 1]
    return float(np.clip(np.quantile(last, search.quantile), 0.0, 0.999))


def fit(classes: DataFrame, size: int, rows: int, search: Search) -> Index:
    """Hash functions for `rows` distinct vectors; the neighbours' cosine comes from a sample."""
    wanted = max(search.k + 2, min(search.sample_rows, search.sample_numbers // size))
    buckets = 1_000_000
    share = min(buckets, max(1, wanted * buckets // max(rows, 1)))
    chosen = classes.filter(F.pmod(F.xxhash64(F.lit("vector sample"), "_class"), F.lit(buckets)) < share)
    sample = unit(_matrix(chosen.select("vec").toArrow().column("vec").combine_chunks()))
    cosine = 0.5
    if len(sample) > search.k + 1:
        cosine = fitted_cosine(sample, search)
    slots = 2.5 / search.width + 1  # of a projection, roughly, that hold most rows
    dims = max(2, min(12, round(math.log(max(rows, 1) / search.bucket_rows, slots)))) if rows > 1 else 2
    return Index(search, size, dims, cosine)


PLACED = "table int, chunk int, kind int, class string, ids array<bigint>, limits array<double>, vec "


def _bucketed(index: Index):
    """The table and bucket of each row in each table."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            units = unit(_matrix(part.column("vec")))
            for number in range(index.search.tables if len(units) else 0):
                buckets = pa.array(index.buckets(units, number))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(units), number, dtype=np.int32)), buckets], names=["table", "bucket"]
                )

    return run


def _batch(number: int, chunk: pa.Array, kind: int, rows: pa.RecordBatch, limits: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(rows), number, dtype=np.int32)),
            chunk,
            pa.array(np.full(len(rows), kind, dtype=np.int32)),
            rows.column("class") if kind == ASKED else pa.nulls(len(rows), pa.string()),
            rows.column("ids"),
            limits,
            rows.column("vec"),
        ],
        names=["table", "chunk", "kind", "class", "ids", "limits", "vec"],
    )


def _dealt(index: Index, chunks: int, large: dict[tuple[int, int], int]):
    """Rows (class, ids, vec) in each table's chunk that their bucket is dealt to; a bucket of `large` is dealt to several."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            units = unit(_matrix(part.column("vec")))
            for number in range(index.search.tables if len(units) else 0):
                buckets = index.buckets(units, number)
                spread = buckets.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
                pieces = np.array([large.get((number, b), 1) for b in buckets.tolist()])
                for i in np.flatnonzero(pieces > 1):
                    spread[i] += np.uint64(zlib.crc32(part.column("class")[i].as_buffer()) % int(pieces[i]))
                chunk = pa.array((spread % np.uint64(chunks)).astype(np.int32))
                yield _batch(number, chunk, INDEXED, part, pa.nulls(len(part), pa.list_(pa.float64())))

    return run


def _asked(index: Index, chunks: int):
    """Queries (class, ids, vec) with their limits, for each chunk of each table."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for start in range(0, len(part), index.search.block):
                block = part.slice(start, index.search.block)
                units = unit(_matrix(block.column("vec")))
                for number in range(index.search.tables):
                    limits = pa.array(list(index.limits(units, number)), pa.list_(pa.float64()))
                    for chunk in range(chunks):
                        at = pa.array(np.full(len(block), chunk, dtype=np.int32))
                        yield _batch(number, at, ASKED, block, limits)

    return run


class _Chunk:
    """A chunk's rows in order of their buckets."""

    RUN = 2048  # rows, about, that meet a block of queries at once

    def __init__(self, index: Index, number: int, vectors: np.ndarray, ids: list[list[int]]):
        self.index, self.number = index, number
        units = unit(vectors)
        buckets, own = np.unique(index.slots(units, number), axis=0, return_inverse=True)
        order = np.argsort(own.ravel(), kind="stable")
        self.vectors, self.units, self.ids = vectors[order], units[order], [ids[i] for i in order]
        self.starts = np.r_[0, np.cumsum(np.bincount(own.ravel(), minlength=len(buckets)))]
        # A bucket's cost is that of its first slots and that of its others; many buckets share either.
        half = index.dims // 2
        self.parts = [
            (at, *np.unique(buckets[:, at], axis=0, return_inverse=True))
            for at in (np.arange(half), np.arange(half, index.dims))
        ]
        wanted = np.r_[np.arange(0, len(vectors), self.RUN), len(vectors)]
        self.cuts = np.unique(np.searchsorted(self.starts, wanted))

    def visited(self, units: np.ndarray, limits: np.ndarray):
        """Which of the buckets between two numbers (unit) queries visit."""
        found = []
        for cosine, most in zip(self.index.probed_cosines(), limits.T, strict=True):
            first, costs = self.index.costs(units, self.number, cosine)
            # Slots beyond those that any of these queries may ask have no chance.
            costs = np.pad(costs, ((0, 0), (0, 0), (1, 1)), constant_values=np.inf)
            sums = []
            for at, slots, own in self.parts:
                place = np.clip(slots - first + 1, 0, costs.shape[2] - 1)
                total = np.zeros((len(units), len(slots)))
                for i, p in zip(at, place.T, strict=True):
                    total += costs[:, i, p]
                sums.append((total, own.ravel()))
            found.append((sums, np.where(np.isinf(most), np.finfo(np.float64).max, most)[:, None]))

        def between(a: int, b: int) -> np.ndarray:
            hit = np.zeros((len(units), b - a), dtype=bool)
            for ((x, own_x), (y, own_y)), most in found:
                hit |= x[:, own_x[a:b]] + y[:, own_y[a:b]] <= most
            return hit

        return between

    def best(self, asked: np.ndarray, limits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, cosine) of each query's k + 1 best rows in buckets that it visits, and of those that tie with the last."""
        units = unit(asked)
        between = self.visited(units, limits)
        top = np.full((len(asked), k + 1), -3.0)  # the best so far, the last one first
        found = []
        for a, b in zip(self.cuts, self.cuts[1:], strict=False):
            hit = between(a, b)
            who = np.flatnonzero(hit.any(axis=1))
            if not len(who):
                continue
            counts = np.diff(self.starts[a : b + 1])
            near = units[who] @ self.units[self.starts[a] : self.starts[b]].T
            near[~np.repeat(hit[who], counts, axis=1)] = -3.0
            better = np.flatnonzero(near.max(axis=1) > top[who, 0])
            if len(better):
                last = max(0, near.shape[1] - k - 1)
                own = np.partition(near[better], last, axis=1)[:, last:]
                both = np.sort(np.concatenate([top[who[better]], own], axis=1), axis=1)
                top[who[better]] = both[:, -k - 1 :]
            # Rounding mustn't decide, so whatever may be equal to the last one stays.
            at, row = np.nonzero(near >= np.maximum(top[who, 0] - 1e-9, -2.0)[:, None])
            found.append((who[at], self.starts[a] + row, near[at, row]))
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        at, row, near = (np.concatenate(x) for x in zip(*found, strict=True))
        stay = near >= top[at, 0] - 1e-9
        at, row = at[stay], row[stay]
        return at, row, cosines(asked[at], self.vectors[row])


class _Best:
    """The best classes of each query that a task has met."""

    def __init__(self, keep: int, limit: int = 400_000):
        self.keep, self.limit, self.count, self.full = keep, limit, 0, False
        self.names: dict[str, int] = {}
        self.blocks: list[tuple[np.ndarray, ...]] = []
        self.ids: list[list[int]] = []

    def add(self, queries: list[str], ids: list[list[int]], at: np.ndarray, member: np.ndarray, score: np.ndarray):
        number = np.array([self.names.setdefault(q, len(self.names)) for q in queries], dtype=np.int64)
        first = len(self.ids)
        used, where = np.unique(member, return_inverse=True)
        self.ids += [ids[m] for m in used]
        least = np.array([ids[m][0] for m in used], dtype=np.int64)
        self.blocks.append((number[at], score, least[where], first + where))
        self.count += len(at)
        if self.count > self.limit:
            self.reduce()

    def reduce(self) -> None:
        if not self.blocks:
            return
        query, score, least, ids = (np.concatenate(x) for x in zip(*self.blocks, strict=True))
        order = np.lexsort((least, -score, query))
        query, score, least, ids = query[order], score[order], least[order], ids[order]
        # The same class may come from several buckets.
        fresh = np.r_[True, (query[1:] != query[:-1]) | (least[1:] != least[:-1]) | (score[1:] != score[:-1])]
        query, score, least, ids = query[fresh], score[fresh], least[fresh], ids[fresh]
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
        top = rank < self.keep
        used, where = np.unique(ids[top], return_inverse=True)
        self.ids = [self.ids[i] for i in used]
        self.blocks = [(query[top], score[top], least[top], where)]
        self.count = int(top.sum())
        # What is kept for so many queries that it no longer gets smaller is given out.
        self.full = self.count > self.limit // 2

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.reduce()
        if self.blocks:
            names = list(self.names)
            query, score, _, ids = self.blocks[0]
            for start in range(0, len(query), 10_000):
                part = slice(start, start + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[q] for q in query[part]], pa.string()),
                        pa.array(score[part]),
                        pa.array([self.ids[i] for i in ids[part]], pa.list_(pa.int64())),
                    ],
                    names=["class", "score", "ids"],
                )
        self.__init__(self.keep, self.limit)


def _ranked(index: Index):
    """Within a task's chunks: exact cosines of queries and rows that they visit, the best of each query."""
    k = index.search.k

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(k + 1)
        current, vectors, ids, chunk = None, [], [], None
        for part in parts:
            keys = np.stack([part.column(c).to_numpy() for c in ("table", "chunk", "kind")], axis=1)
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
            for a, b in zip(cuts, cuts[1:], strict=False):
                if tuple(keys[a, :2]) != current:
                    current, vectors, ids, chunk = tuple(keys[a, :2]), [], [], None
                rows = part.slice(a, b - a)
                if keys[a, 2] == INDEXED:
                    vectors.append(_matrix(rows.column("vec")))
                    ids += rows.column("ids").to_pylist()
                    continue
                if chunk is None:
                    if not vectors:
                        continue
                    chunk = _Chunk(index, current[0], np.concatenate(vectors), ids)
                    vectors = ids = None
                for start in range(0, len(rows), index.search.block):
                    block = rows.slice(start, index.search.block)
                    asked = _matrix(block.column("vec"))
                    found = chunk.best(asked, _matrix(block.column("limits")), k)
                    best.add(block.column("class").to_pylist(), chunk.ids, *found)
                    if best.full:
                        yield from best.rows()
        yield from best.rows()

    return run


def nearest(vectors: DataFrame, queries: DataFrame, search: Search | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for `queries` against all `vectors`, both (vec_id, vec)."""
    search = search or Search()
    spark = vectors.sparkSession
    # Floats stay floats, which take half the room in a shuffle; the arithmetic is in doubles.
    kinds = {df.schema["vec"].dataType.simpleString() for df in (vectors, queries)}
    kind = "array<float>" if kinds == {"array<float>"} else "array<double>"
    rows = usable(vectors, kind).withColumn("_size", F.size("vec"))
    asked = usable(queries, kind)
    common = rows.groupBy("_size").count().orderBy(F.desc("count"), "_size").first()
    size = common["_size"] if common else 1
    rows, asked = rows.filter(F.col("_size") == size), asked.filter(F.size("vec") == size)
    smallest = Window.partitionBy("_class").orderBy("vec_id")
    classes = stored(
        rows.groupBy("_class", "vec_id")
        .agg(F.any_value("vec").alias("vec"))
        .withColumn("_row", F.row_number().over(smallest))
        .filter(F.col("_row") <= search.k + 1)
        .groupBy("_class")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.any_value("vec").alias("vec")),
        "vectors",
    )
    count = classes.count()
    index = fit(classes, size, count, search)
    named = F.col("_class").alias("class")
    placed = PLACED + kind
    cores = spark.sparkContext.defaultParallelism
    chunks = max(1, min(-(-count // search.chunk_rows), max(cores, -(-count * size // search.chunk_numbers))))
    # Buckets of more than a quarter of a chunk, of which there are few.
    most = max(1, count // (4 * chunks))
    sizes = classes.select("vec").mapInArrow(_bucketed(index), "table int, bucket bigint").groupBy("table", "bucket").count()
    large = {(r["table"], r["bucket"]): -(-r["count"] // most) for r in sizes.filter(F.col("count") > most).collect()}
    indexed = classes.select(named, "ids", "vec").mapInArrow(_dealt(index, chunks, large), placed)
    # A few questions are little data but much work, so their partitions are not left to be merged by size.
    tasks = search.probing_tasks or cores
    questions = asked.repartition(tasks, "_class").groupBy("_class").agg(F.any_value("vec").alias("vec"))
    no_ids = F.array().cast("array<bigint>").alias("ids")
    probing = questions.select(named, no_ids, "vec").mapInArrow(_asked(index, chunks), placed)

    keys = ["table", "chunk"]
    found = (
        indexed.unionByName(probing)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "kind")
        .mapInArrow(_ranked(index), "class string, score double, ids array<bigint>")
    )
    merged = (
        found.select("class", "score", F.explode("ids").alias("vec_id"))
        .groupBy("class", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn(
            "_place", F.row_number().over(Window.partitionBy("class").orderBy(F.desc("score"), "vec_id"))
        )
        .filter(F.col("_place") <= search.k + 1)
        .groupBy(F.col("class").alias("_class"))
        .agg(F.sort_array(F.collect_list(F.struct("_place", "vec_id", "score"))).alias("_found"))
    )
    answered = salted_lookup(asked.select("vec_id", "_class").distinct(), merged, "_class", F.col("vec_id"))
    query_id = F.col("vec_id")
    others = F.filter("_found", lambda x: x["vec_id"] != query_id)
    return answered.select(
        query_id.alias("query_id"), F.posexplode(F.slice(others, 1, search.k)).alias("_at", "_hit")
    ).select(
        "query_id",
        (F.col("_at") + 1).alias("rank"),
        F.col("_hit.vec_id").alias("vec_id"),
        F.col("_hit.score").alias("score"),
    )


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
