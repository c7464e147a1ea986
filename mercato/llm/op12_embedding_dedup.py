"""Near copies among embeddings: an epsilon grid order join within labels.

On the unit sphere a cosine of `least` is a distance, epsilon. Vectors are rotated onto their principal
components, which keeps distances, so how far two vectors' first coordinates lie apart bounds their
distance from below.

1. Equal vectors of a label become one class, which knows its number and its smallest id.
2. Classes are sorted by label, by their cells in a grid over the leading components, and within a
   cell by the first component: a range partitioning. Each partition is cut into intervals of at most
   `interval_bytes`, and each interval keeps the bounds of its coordinates.
3. Pairs of intervals are found by recursion from the whole sequence of a label: a pair is split into
   pairs of shorter runs, and those whose bounds are farther apart than epsilon are skipped with all that
   is below them. Only bounds take part in this, not vectors.
4. Each remaining pair of intervals is one unit of work. It is joined by the same recursion down to
   blocks of `block_rows` vectors, whose cosines are worked out; a cosine within rounding of the threshold
   is worked out anew from the original vectors. A unit gives each class's number of links, and one edge
   per class to the smallest linked one in the unit. So a group of near copies is never written out as pairs.
5. The edges' components, and the smallest id of each.

The rotation is fitted on a bounded sample (`sample_numbers`); it decides how much is skipped, never what is
found. Vectors of a length that the sample lacks keep their coordinates.

Rows with a NULL label or id, and vectors that are NULL, empty, all zero, or hold NULL or non-finite
components link with nothing: n_links 0, component_id their own id, kept true. Vectors of different
lengths don't link. Rows that repeat an id are rows of their own, and an equal row is a link.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import ddl, salted_lookup, stored, table
from mercato.llm.components import components


@dataclass(frozen=True)
class Near:
    least: float = 0.93  # cosine
    grid_dims: int = 6
    bound_dims: int = 32  # leading components of which bounds are kept
    interval_bytes: int = 2_000_000  # of an interval's vectors, as doubles
    block_rows: int = 256
    fanout: int = 8  # runs into which a run of intervals is split
    units_per_task: int = 16
    sample_numbers: int = 2_000_000  # rows times components
    sample_rows: int = 20_000

    @property
    def reach(self) -> float:
        """The largest squared distance of a link, with room for rounding."""
        return 2 - 2 * self.least + 1e-9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by a power of two, so that squares don't overflow."""
    scaled = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, initial=0.0))[1][:, None])
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, whatever other rows are in the block."""
    a, b = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0.0))[1][:, None]) for x in (a, b))
    dot, aa, bb = (np.einsum("ij,ij->i", x, y) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (np.sqrt(aa) * np.sqrt(bb))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _usable() -> Column:
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vec", lambda x: x != 0),
        F.lit(False),
    )


# ---- the rotation


def fit(classes: DataFrame, near: Near) -> dict[int, np.ndarray]:
    """By length of vector (the most frequent ones): the leading principal components as columns."""
    sizes = classes.groupBy("_size").count().orderBy(F.desc("count"), "_size").limit(8).collect()
    buckets, found = 1_000_000, {}
    for size, rows in sizes:
        wanted = max(2, min(near.sample_rows, near.sample_numbers // size) // len(sizes))
        share = min(buckets, max(1, wanted * buckets // rows))
        place = F.pmod(F.xxhash64(F.lit("rotation sample"), "_class"), F.lit(buckets))
        chosen = classes.filter((F.col("_size") == size) & (place < share)).select("vec").limit(2 * wanted)
        sample = chosen.toArrow().column("vec").combine_chunks()
        if len(sample) > 1:
            units = unit(_matrix(sample))
            principal = np.linalg.eigh(np.cov(units, rowvar=False).reshape(size, size))[1][:, ::-1]
            found[size] = principal[:, : max(near.grid_dims, near.bound_dims)].copy()
    return found


def rotated(units: np.ndarray, rotations: dict[int, np.ndarray], dims: int) -> np.ndarray:
    """The leading coordinates of (unit) vectors of one length."""
    rotation = rotations.get(units.shape[1])
    return units[:, :dims] if rotation is None else units @ rotation[:, :dims]


# ---- the sequence and its intervals


def _placed(shared, near: Near):
    """Classes with their cells in the grid and their first coordinate."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = math.sqrt(near.reach)
        for part in parts:
            sizes = part.column("_size").to_numpy()
            cells, first = [None] * len(part), np.zeros(len(part))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                units = unit(_matrix(part.column("vec").take(pa.array(at))))
                places = rotated(units, shared.value, near.grid_dims)
                first[at] = places[:, 0]
                for i, row in zip(at, np.floor(places / width).astype(np.int32).tolist(), strict=True):
                    cells[i] = row
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(cells, pa.list_(pa.int32())), pa.array(first)],
                names=[*part.schema.names, "_cells", "_first"],
            )

    return run


def _cut(near: Near):
    """Sorted rows with a number of their own, which rises, and their interval's number within the partition and group."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        group, interval, place, node = None, 0, 0, partition << 40
        for part in parts:
            intervals = np.zeros(len(part), np.int64)
            labels, sizes = part.column("label").to_pylist(), part.column("_size").to_pylist()
            for i, own in enumerate(zip(labels, sizes, strict=True)):
                if own != group:
                    group, interval, place = own, 0, 0
                    room = max(near.block_rows, near.interval_bytes // (8 * own[1]))
                elif place == room:
                    interval, place = interval + 1, 0
                intervals[i] = interval
                place += 1
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns,
                    pa.array(np.arange(node, node + len(part), dtype=np.int64)),
                    pa.array(np.full(len(part), partition, dtype=np.int64)),
                    pa.array(intervals),
                ],
                names=[*part.schema.names, "node", "_part", "_interval"],
            )
            node += len(part)

    return run


GROUP = ["label", "_size"]


def _bounds(shared, near: Near):
    """Bounds of the coordinates of the rows that share (group, partition, interval) in a batch."""
    keys = [*GROUP, "_part", "_interval"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = [part.column(c).to_numpy(zero_copy_only=False) for c in keys]
            changed = np.zeros(len(part), dtype=bool)
            for c in columns:
                changed[1:] |= c[1:] != c[:-1]
            cuts = np.flatnonzero(np.r_[len(part) > 0, changed[1:], True]) if len(part) else []
            out = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                places = rotated(unit(_matrix(part.column("vec").slice(a, b - a))), shared.value, near.bound_dims)
                own = (part.column(c)[a].as_py() for c in keys)
                out.append((*own, places.min(axis=0).tolist(), places.max(axis=0).tolist()))
            if out:
                doubles = pa.list_(pa.float64())
                kinds = [*(part.schema.field(c).type for c in keys), doubles, doubles]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=[*keys, "low", "high"],
                )

    return run


def _merged(bounds: DataFrame, keys: list[str], dims: int) -> DataFrame:
    """Bounds of all rows that share `keys`."""
    each = range(dims)
    merged = bounds.groupBy(*keys).agg(
        *(F.min(F.get("low", F.lit(i))).alias(f"_l{i}") for i in each),
        *(F.max(F.get("high", F.lit(i))).alias(f"_h{i}") for i in each),
    )
    low, high = (F.array_compact(F.array(*(F.col(f"_{x}{i}") for i in each))) for x in "lh")
    return merged.select(*keys, low.alias("low"), high.alias("high"))


def _gap(near: Near) -> Column:
    """Whether two runs' bounds leave room for a link."""

    def between(a: str, b: str) -> Column:  # how far a's coordinates lie above b's
        return F.zip_with(f"{a}.low", f"{b}.high", lambda low, high: F.greatest(low - high, F.lit(0.0)))

    apart = F.zip_with(between("a", "b"), between("b", "a"), lambda x, y: x * x + y * y)
    return F.aggregate(apart, F.lit(0.0), lambda total, x: total + x) <= near.reach


def interval_pairs(bounds: DataFrame, near: Near) -> DataFrame:
    """(label, _size, a, b) with a <= b: intervals, numbered in the group's order, that may hold a link."""
    most = bounds.agg(F.max("seq")).first()[0] or 0
    levels = [bounds.withColumnRenamed("seq", "node")]
    while most > 0:
        most //= near.fanout
        up = levels[-1].withColumn("node", F.floor(F.col("node") / near.fanout))
        levels.append(stored(_merged(up, [*GROUP, "node"], near.bound_dims), "runs"))
    pairs = levels[-1].select(*GROUP, F.col("node").alias("a"), F.col("node").alias("b"))
    for level in levels[-2::-1]:
        runs = level.withColumn("parent", F.floor(F.col("node") / near.fanout))
        for side in ("a", "b"):
            children = runs.select(
                *GROUP, F.col("parent").alias(side), F.struct("node", "low", "high").alias(f"_{side}")
            )
            pairs = pairs.join(children, [*GROUP, side])
        pairs = pairs.select(*GROUP, F.col("_a").alias("a"), F.col("_b").alias("b"))
        pairs = pairs.filter((F.col("a.node") <= F.col("b.node")) & _gap(near))
        pairs = stored(pairs.select(*GROUP, F.col("a.node").alias("a"), F.col("b.node").alias("b")), "pairs")
    return pairs


# ---- a unit of work


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i]; a parent is never larger than its child."""
    while True:
        for x in (a, b):
            while True:
                up = parent[x]
                if (up == x).all():
                    break
                x[:] = up
        other = a != b
        if not other.any():
            return
        a, b = a[other], b[other]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


class Unit:
    """Two intervals, or one with itself: links counted per vector, and who is connected."""

    def __init__(self, vectors: list[np.ndarray], weights: list[np.ndarray], rotations, near: Near):
        self.near, self.vectors, self.weights = near, vectors, weights
        self.units = [unit(v) for v in vectors]
        self.places = [rotated(u, rotations, near.bound_dims) for u in self.units]
        self.links = [np.zeros(len(v), dtype=np.int64) for v in vectors]
        self.first = [0, len(vectors[0]) if len(vectors) > 1 else 0]  # of each side, as a node
        self.parent = np.arange(sum(map(len, vectors)))
        last = len(vectors) - 1
        self.join(0, len(vectors[0]), 0, len(vectors[last]), last)

    def join(self, a0: int, a1: int, b0: int, b1: int, side: int) -> None:
        """Rows a0 to a1 of the first interval with rows b0 to b1 of the other one, or of itself."""
        same = side == 0 and a0 == b0
        a, b = self.places[0][a0:a1], self.places[side][b0:b1]
        if not same:
            gap = np.maximum(0, np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0)))
            if gap @ gap > self.near.reach:
                return
        if max(a1 - a0, b1 - b0) <= self.near.block_rows:
            self.block(a0, a1, b0, b1, side, same)
            return
        halves = [
            [(x, (x + y) // 2), ((x + y) // 2, y)] if y - x > self.near.block_rows else [(x, y)]
            for x, y in ((a0, a1), (b0, b1))
        ]
        for x in halves[0]:
            for y in halves[1]:
                if not same or x[0] <= y[0]:
                    self.join(*x, *y, side)

    def block(self, a0: int, a1: int, b0: int, b1: int, side: int, same: bool) -> None:
        near = self.units[0][a0:a1] @ self.units[side][b0:b1].T
        if same:
            near = np.triu(near, 1)  # zeros don't link
        i, j = np.nonzero(near >= self.near.least - 1e-9)
        unsure = np.flatnonzero(near[i, j] < self.near.least + 1e-9)
        if len(unsure):
            exact = cosines(self.vectors[0][a0 + i[unsure]], self.vectors[side][b0 + j[unsure]])
            drop = unsure[exact < self.near.least]
            i, j = np.delete(i, drop), np.delete(j, drop)
        if not len(i):
            return
        i, j = i + a0, j + b0
        np.add.at(self.links[0], i, self.weights[side][j])
        np.add.at(self.links[side], j, self.weights[0][i])
        unite(self.parent, i + self.first[0], j + self.first[side])

    def roots(self) -> np.ndarray:
        root = self.parent
        while (root != root[root]).any():
            root = root[root]
        return root


def _joined(shared, near: Near):
    """Units' rows, one unit after the other and its first interval first, to (node, root, links) of linked classes."""

    def results(sides: list[list[tuple]]) -> pa.RecordBatch:
        nodes, weights, vectors = ([np.concatenate([rows[k] for rows in own]) for own in sides] for k in range(3))
        done = Unit(vectors, weights, shared.value, near)
        node, links = np.concatenate(nodes), np.concatenate(done.links)
        linked = links > 0
        found = (node, node[done.roots()], links)
        return pa.RecordBatch.from_arrays([pa.array(x[linked]) for x in found], names=["node", "root", "links"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, sides = None, []
        for part in parts:
            if not len(part):
                continue
            unit_of = part.column("_unit").to_numpy(zero_copy_only=False)
            side = part.column("_side").to_numpy()
            cuts = np.flatnonzero(np.r_[True, (unit_of[1:] != unit_of[:-1]) | (side[1:] != side[:-1]), True])
            for x, y in zip(cuts, cuts[1:], strict=False):
                if unit_of[x] != current:
                    if sides:
                        yield results(sides)
                    current, sides = unit_of[x], []
                if side[x] == len(sides):
                    sides.append([])
                rows = part.slice(x, y - x)
                sides[-1].append(
                    (rows.column("node").to_numpy(), rows.column("n").to_numpy(), _matrix(rows.column("vec")))
                )
        if sides:
            yield results(sides)

    return run


# ---- the whole


def sequence(vectors: DataFrame, near: Near) -> tuple[DataFrame, Broadcast]:
    """The classes of usable `vectors` in epsilon grid order, cut into intervals; the rotations."""
    classes = stored(
        vectors.filter("_usable")
        .groupBy("_class")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("vec").alias("vec"),
            F.count("*").alias("n"),
            F.min("vec_id").alias("least_id"),
        )
        .withColumn("_size", F.size("vec")),
        "vectors",
    )
    rotations = vectors.sparkSession.sparkContext.broadcast(fit(classes, near))
    order = [*GROUP, "_cells", "_first", "_class"]
    cut = (
        classes.mapInArrow(_placed(rotations, near), ddl(classes, "_cells array<int>, _first double"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("_cells", "_first")
        .mapInArrow(_cut(near), ddl(classes, "node bigint, _part bigint, _interval bigint"))
    )
    return stored(cut, "sequence"), rotations


def near_copies(vectors: DataFrame, near: Near | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of `vectors` (vec_id, vec, label)."""
    near = near or Near()
    spark = vectors.sparkSession
    kind = "array<float>" if vectors.schema["vec"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select("vec_id", F.col("vec").cast(kind).alias("vec"), "label").withColumn("_usable", _usable())
    hashes = F.xxhash64("label", "vec"), F.xxhash64(F.lit("class"), "label", "vec")
    rows = rows.withColumn("_class", F.when(F.col("_usable"), F.concat_ws(":", *hashes)))
    cut, rotations = sequence(rows, near)

    # Intervals are numbered in the order of their group.
    of_part, of_interval = [*GROUP, "_part"], [*GROUP, "_part", "_interval"]
    before = Window.partitionBy(*GROUP).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*of_part)
        .agg((F.max("_interval") + 1).alias("_count"))
        .select(*of_part, F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_offset"))
    )
    number = (F.col("_offset") + F.col("_interval")).alias("seq")
    keys = cut.select(*of_interval)
    pieces = cut.select(*of_interval, "vec").mapInArrow(
        _bounds(rotations, near), ddl(keys, "low array<double>, high array<double>")
    )
    bounds = _merged(pieces, of_interval, near.bound_dims).join(offsets, of_part).select(*GROUP, number, "low", "high")
    pairs = interval_pairs(stored(bounds, "bounds"), near)

    # Every interval goes to the units that it takes part in, once to that with itself.
    units = pairs.select(*GROUP, "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("seq"))
    work = (
        cut.join(offsets, of_part)
        .select(*GROUP, number, "node", "n", "vec")
        .join(units, [*GROUP, "seq"])
        .select(
            F.concat_ws("|", "_size", "a", "b", "label").alias("_unit"),
            (F.col("seq") != F.col("a")).cast("int").alias("_side"),
            "node",
            "n",
            "vec",
        )
    )
    # A stated number, as small inputs of long work would be put into few tasks.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), pairs.count() // near.units_per_task)
    linked = stored(
        work.repartition(tasks, "_unit")
        .sortWithinPartitions("_unit", "_side", "node")
        .mapInArrow(_joined(rotations, near), "node bigint, root bigint, links bigint"),
        "links",
    )
    rotations.unpersist()

    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    numbers = cut.select("node", "_class", "n", "least_id")
    of_root = numbers.join(roots, "node")
    smallest = of_root.groupBy("root").agg(F.min("least_id").alias("_smallest"))
    reached = salted_lookup(of_root.select("node", "root"), smallest, "root", F.col("node")).drop("root")
    links = linked.groupBy("node").agg(F.sum("links").alias("_links"))
    known = (
        numbers.join(links, "node", "left")
        .join(reached, "node", "left")
        .filter("n > 1 or _links is not null")
        .select(
            "_class",
            (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("_smallest", "least_id").alias("component_id"),
        )
    )
    found = salted_lookup(rows.filter("_usable").select("vec_id", "_class"), known, "_class", F.col("vec_id"))
    alone = rows.filter("not _usable").select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    found = found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return found.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return near_copies(vectors.select("vec_id", F.col("embedding").alias("vec"), "label"))


ORACLE = f"""
  with recursive v as (select row_number() over () rid, vec_id, label, embedding from embeddings),
    u as (
      select rid, vec_id, label, list_transform(embedding, lambda x: x::double) e from v
      where vec_id is not null and label is not null and len(embedding) > 0
        and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
        and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
    links as (
      select a.rid a, b.rid b from u a join u b on a.label = b.label and a.rid <> b.rid
        and case when len(a.e) = len(b.e) then list_cosine_similarity(a.e, b.e) >= {Near.least} else false end),
    reach(rid, other) as (
      select rid, rid from v
      union
      select r.rid, l.b from reach r join links l on l.a = r.other),
    least as (select r.rid, min(o.vec_id) component_id from reach r join v o on o.rid = r.other group by r.rid),
    counts as (select a rid, count(*) n_links from links group by a)
  select vec_id, coalesce(n_links, 0)::bigint n_links, component_id,
    vec_id is not distinct from component_id kept
  from v join least using (rid) left join counts using (rid)
"""
