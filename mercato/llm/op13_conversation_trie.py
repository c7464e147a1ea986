"""A trie of conversation prefixes, built from adaptive radix trees over turn ids.

A turn's id is a 16-byte digest of its role and text, big-endian, so a conversation is a byte string of
its turns' ids, and the trie's nodes are those at byte depths that are multiples of 16.

1. Turns are sorted by conversation and turn (a range partitioning, so that a conversation of any length is
   sorted by several tasks) and numbered. Each conversation gets the first turns of its base.
2. Conversations are cut into segments of `segment_turns` turns, nearly always one. A segment's key is its
   turns' ids; equal keys become one with a count, map-side first, so copies cost one key.
3. Keys are sorted by a range partitioning and cut into blocks of bounded size. Each block builds a radix tree:
   nodes for 4, 16, 48 or 256 children, growing as needed, with compressed paths. A block knows how many
   turns its first key shares with the last one before it and its last with the first one after it. So it
   knows which nodes are also in other blocks, counts as its own only what no block before it has, and its
   nodes' figures either are final or add up. Those that add up, at most two paths a block, are summed.
4. Longer conversations go segment by segment from the last to the first: a segment's last node takes on
   the figures of what is below it.
5. The ids of the conversations that end in a node are hashed in numerical order as a stream. A hash of one
   list can't be split, so ids of equal conversations meet in one task, which keeps none of them.

A node is named by its depth and the exclusive or of its turns' hashes (of position and id, 120 bits), which
can be had at any depth without the turns before. Turns of equal number are ordered by the digest of role and
text. Rows with a NULL conv_id are of no conversation and are left out. Repeated rows are turns of their own.
c%20 has the sign of c. A base's turns are numbered before it is rebuilt itself. No rows give no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import batches, ddl, hex_number, id_text, salted_lookup, stored, table

WIDTH = 16  # bytes of a turn's id
GROUP = 20  # conversations that share a base
HEADS = 4  # a conversation takes fewer turns than this from its base
NO_ENDS = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Layout:
    segment_turns: int = 4096
    block_bytes: int = 2_000_000
    block_keys: int = 10_000


# ---- conversations


def _numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns with their partition and their place among the conversation's turns in it."""
    partition, current, place = TaskContext.get().partitionId(), None, 0
    for part in parts:
        if not len(part):
            continue
        conv = part.column("conv_id").to_numpy()
        starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        sizes = np.diff(np.r_[starts, len(conv)])
        at = np.arange(len(conv)) - np.repeat(starts, sizes)
        if conv[0] == current:
            at[: sizes[0]] += place
        current, place = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*part.columns, pa.array(np.full(len(part), partition)), pa.array(at)],
            names=[*part.schema.names, "_part", "_at"],
        )


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, digest, words): turns in order, numbered from 0."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        digest.alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "digest"]
    placed = stored(
        turns.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("turn")
        .mapInArrow(_numbered, "conv_id bigint, digest binary, words bigint, _part bigint, _at bigint"),
        "turns",
    )
    # Where a conversation goes on from one partition to the next: at most two rows a partition.
    pieces = placed.groupBy("conv_id", "_part").agg((F.max("_at") + 1).alias("_count"))
    before = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.withColumn("_offset", F.sum("_count").over(before)).filter("_offset is not null").drop("_count")
    number = F.col("_at") + F.coalesce(F.col("_offset"), F.lit(0))
    return placed.join(F.broadcast(offsets), ["conv_id", "_part"], "left").select(
        "conv_id", number.alias("pos"), "digest", "words"
    )


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id), and the turns (conv_id, pos, digest, words) that they have after rebuilding."""
    conv = F.col("conv_id")
    own_head = F.crc32(id_text("conv_id")) % HEADS
    convs = stored(turns.select("conv_id").distinct(), "conversations")
    heads = (
        turns.filter((conv % GROUP == 0) & (F.col("pos") < HEADS - 1))
        .groupBy(conv.alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    )
    headed = convs.withColumn("base", conv - conv % GROUP).join(heads, "base", "left")
    none = F.array().cast(heads.schema["head"].dataType)
    headed = headed.select("conv_id", F.slice(F.coalesce("head", none), F.lit(1), own_head.cast("int")).alias("head"))
    # Where the base has fewer turns, the conversation's own come earlier.
    shifts = headed.select("conv_id", (own_head - F.size("head")).alias("shift")).filter("shift > 0")
    own = salted_lookup(turns.filter(F.col("pos") >= own_head), shifts, "conv_id", F.col("pos")).select(
        "conv_id", (F.col("pos") - F.coalesce("shift", F.lit(0))).alias("pos"), "digest", "words"
    )
    return convs, own.unionByName(headed.select("conv_id", F.inline("head")))


# ---- keys


def _lane(pos: Column, digest: Column, which: int) -> Column:
    name = F.md5(F.concat(F.encode(F.concat(pos.cast("string"), F.lit(":")), "utf-8"), digest))
    return hex_number(name, 1 + 15 * which, 15)


def _lanes(pos: int, digest: bytes) -> tuple[int, int]:
    name = hashlib.md5(b"%d:%b" % (pos, digest)).hexdigest()
    return int(name[:15], 16), int(name[15:30], 16)


def node_name(depth, one, two) -> Column:
    return F.concat_ws(":", depth, one, two)


def segments(convs: DataFrame, turns: DataFrame, layout: Layout) -> DataFrame:
    """(conv_id, segment, key, words, s1, s2, e1, e2, depth, is_last): s and e name the nodes before and after it."""
    cut = (
        turns.withColumn("segment", F.floor(F.col("pos") / layout.segment_turns))
        .groupBy("conv_id", "segment")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns"),
            *(F.bit_xor(_lane(F.col("pos"), F.col("digest"), i)).alias(f"_x{i + 1}") for i in (0, 1)),
        )
        .select(
            "conv_id",
            "segment",
            F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("key"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
            "_x1",
            "_x2",
        )
    )
    # Conversations without a turn have an empty first segment.
    cut = convs.join(cut, "conv_id", "left").select(
        "conv_id",
        F.coalesce("segment", F.lit(0)).alias("segment"),
        F.coalesce("key", F.lit(b"")).alias("key"),
        F.coalesce("words", F.array().cast("array<bigint>")).alias("words"),
        *(F.coalesce(f"_x{i}", F.lit(0)).alias(f"_x{i}") for i in (1, 2)),
    )
    own = Window.partitionBy("conv_id").orderBy("segment")
    so_far = own.rowsBetween(Window.unboundedPreceding, 0)
    ended = cut.withColumns(
        {
            "e1": F.bit_xor("_x1").over(so_far),
            "e2": F.bit_xor("_x2").over(so_far),
            "is_last": F.lead("segment").over(own).isNull(),
        }
    )
    return ended.select(
        "conv_id",
        "segment",
        "key",
        "words",
        *(F.col(f"e{i}").bitwiseXOR(F.col(f"_x{i}")).alias(f"s{i}") for i in (1, 2)),
        "e1",
        "e2",
        (F.col("segment") * layout.segment_turns + F.size("words")).alias("depth"),
        "is_last",
    )


def _blocked(layout: Layout):
    """Sorted keys with their partition and block."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, block, size, keys = TaskContext.get().partitionId(), 0, 0, 0
        for part in parts:
            blocks = np.zeros(len(part), np.int64)
            for i, key in enumerate(part.column("key")):
                own = len(key.as_buffer())
                if keys and (size + own > layout.block_bytes or keys == layout.block_keys):
                    block, size, keys = block + 1, 0, 0
                blocks[i] = block
                size, keys = size + own, keys + 1
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(np.full(len(part), partition)), pa.array(blocks)],
                names=[*part.schema.names, "_part", "_block"],
            )

    return run


def shared_turns(a: tuple | None, b: tuple | None) -> int:
    """How many first turns two (s1, s2, key) have in common; -1 if they start at different nodes."""
    if a is None or b is None or a[:2] != b[:2]:
        return -1
    x, y = a[2], b[2]
    low, high = 0, min(len(x), len(y)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if x[: middle * WIDTH] == y[: middle * WIDTH] else (low, middle - 1)
    return low


def _neighbours(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks' first and last keys, and those beside them, to the numbers of turns that they share."""

    def named(x: dict | None) -> tuple | None:
        return None if x is None else (x["s1"], x["s2"], x["key"])

    for part in parts:
        first, last, before, after = (list(map(named, part.column(c).to_pylist())) for c in ("a", "b", "x", "y"))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("_part"),
                part.column("_block"),
                pa.array(list(map(shared_turns, before, first)), pa.int32()),
                pa.array(list(map(shared_turns, last, after)), pa.int32()),
            ],
            names=["_part", "_block", "seen", "follows"],
        )


# ---- the radix tree


class Node:
    """A node with a compressed path before it. Its children are kept in the smallest layout that has room."""

    __slots__ = ("prefix", "room", "bytes", "children", "end", "depth", "low", "high", "n", "least", "leaves", "saved", "kids")

    def __init__(self, prefix: bytes, end: int | None = None):
        self.prefix = prefix
        self.end = end
        self.room = 4
        self.bytes: bytearray | None = None  # 4, 16: the children's bytes; 48: by byte, the place + 1; 256: none
        self.children: list[Node | None] = []

    def find(self, byte: int) -> Node | None:
        if self.room == 256:
            return self.children[byte]
        if self.bytes is None:
            return None
        if self.room == 48:
            place = self.bytes[byte]
            return self.children[place - 1] if place else None
        place = self.bytes.find(byte)
        return self.children[place] if place >= 0 else None

    def put(self, byte: int, child: Node) -> None:
        """Add a child, or replace the one under the same byte."""
        if self.room == 256:
            self.children[byte] = child
            return
        if self.bytes is None:
            self.bytes = bytearray()
        place = self.bytes[byte] - 1 if self.room == 48 else self.bytes.find(byte)
        if place >= 0:
            self.children[place] = child
            return
        if len(self.children) == self.room:
            self._grow()
            self.put(byte, child)
            return
        self.children.append(child)
        if self.room == 48:
            self.bytes[byte] = len(self.children)
        else:
            self.bytes.append(byte)

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            places = bytearray(256)
            for place, byte in enumerate(self.bytes):
                places[byte] = place + 1
            self.room, self.bytes = 48, places
        else:
            by_byte: list[Node | None] = [None] * 256
            for byte, place in enumerate(self.bytes):
                if place:
                    by_byte[byte] = self.children[place - 1]
            self.room, self.bytes, self.children = 256, None, by_byte


def _common(a: bytes, b: bytes) -> int:
    """The length of the common start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    difference = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (difference.bit_length() + 7) // 8


def insert(root: Node | None, key: bytes, end: int) -> Node:
    """The tree with another key."""
    if root is None:
        return Node(key, end)
    above, byte, node, at = None, 0, root, 0
    while True:
        prefix = node.prefix
        same = len(prefix) if key.startswith(prefix, at) else _common(prefix, key[at:])
        if same < len(prefix):  # the path splits within the compressed part
            fork = Node(prefix[:same])
            fork.put(prefix[same], node)
            node.prefix = prefix[same + 1 :]
            if at + same == len(key):
                fork.end = end
            else:
                fork.put(key[at + same], Node(key[at + same + 1 :], end))
            if above is None:
                return fork
            above.put(byte, fork)
            return root
        at += same
        if at == len(key):
            node.end = end
            return root
        child = node.find(key[at])
        if child is None:
            node.put(key[at], Node(key[at + 1 :], end))
            return root
        above, byte, node, at = node, key[at], child, at + 1


NODES = (
    "node string, parent string, depth bigint, is_top boolean, is_part boolean, conv_id bigint, parent_conv_id bigint,"
    " n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
)


def tree_nodes(rows: list[dict], seen: int, follows: int, offset: int) -> Iterator[tuple]:
    """The trie's nodes (as in NODES) among a block's sorted keys that start at the same node.

    `seen` and `follows`: how many turns the first and the last key share with the blocks beside, -1 if none.
    """
    root = None
    for i, row in enumerate(rows):
        root = insert(root, row["key"], i)
    order: list[Node] = []
    stack = [(root, -1)]
    while stack:
        node, above = stack.pop()
        node.depth = above + 1 + len(node.prefix) if above >= 0 else len(node.prefix)
        order.append(node)
        stack += [(c, node.depth) for c in node.children if c is not None]
    last = len(rows) - 1

    def is_new(node: Node, turns: int) -> bool:
        return node.low > 0 or turns > seen

    def words(node: Node, turns: int) -> int:
        return rows[node.low]["words"][turns - 1] if turns else 0

    # Figures of what is below the node's own depth, and of the node itself where it is turn-aligned.
    steps: dict[int, list[tuple[int, int, int, int]]] = {}
    for node in reversed(order):
        children = [c for c in node.children if c is not None]
        node.low = min([c.low for c in children] + ([node.end] if node.end is not None else []))
        node.high = max([c.high for c in children] + ([node.end] if node.end is not None else []))
        own = rows[node.end] if node.end is not None else None
        node.n = sum(c.n for c in children) + (own["n"] if own else 0)
        node.least = min([c.least for c in children] + ([own["least"]] if own else []))
        node.leaves = sum(c.leaves for c in children)
        node.saved = sum(c.saved for c in children)
        following = node.depth // WIDTH + 1  # turns of the next aligned depth
        node.kids = sum(
            (1 if is_new(c, following) else 0) if c.depth >= following * WIDTH else c.kids for c in children
        )
        if own and own["below"]:
            node.kids, node.leaves, node.saved = own["below"]
        elif own and not children and not (node.high == last and node.depth == follows * WIDTH):
            node.leaves = 1
        # Up the compressed path: aligned depths from the node's own to the first one after its parent.
        start = node.depth - len(node.prefix)  # the parent's depth + 1, or 0
        found, kids = [], node.kids
        for turns in range(node.depth // WIDTH, -(-start // WIDTH) - 1, -1):
            if turns:
                node.saved += (node.n - is_new(node, turns)) * words(node, turns)
            found.append((turns, kids, node.leaves, node.saved))
            kids = int(is_new(node, turns))
        steps[id(node)] = found

    names: dict[int, list[tuple[int, int]]] = {}

    def name(i: int, turns: int) -> str:
        if i not in names:
            one, two = rows[i]["s1"], rows[i]["s2"]
            path = [(one, two)]
            key = rows[i]["key"]
            for t in range(len(key) // WIDTH):
                x, y = _lanes(offset + t, key[t * WIDTH : (t + 1) * WIDTH])
                one, two = one ^ x, two ^ y
                path.append((one, two))
            names[i] = path
        one, two = names[i][turns]
        return f"{offset + turns}:{one}:{two}"

    # From the root down, as a node's parent must be known: (conv_id, or None if it isn't final) by node.
    above: dict[int, int | None] = {id(root): None}
    for node in order:
        parent = above.pop(id(node))
        for turns, kids, leaves, saved in reversed(steps.pop(id(node))):
            is_part = (node.low == 0 and turns <= seen) or (node.high == last and turns <= follows)
            yield (
                name(node.low, turns),
                name(node.low, turns - 1) if turns else None,
                offset + turns,
                turns == 0,
                is_part,
                node.least,
                None if is_part else parent,
                node.n,
                kids,
                leaves,
                saved,
            )
            # The node before this segment is another segment's.
            parent = None if is_part or (turns == 0 and offset) else node.least
        for c in node.children:
            if c is not None:
                above[id(c)] = parent
        if node.end is not None and node.low == node.end and not any(node.children):
            names.pop(node.end, None)


def _trees(offset: int):
    """Blocks' sorted keys to nodes."""
    schema = pa.schema(
        [
            *((c, pa.string()) for c in ("node", "parent")),
            ("depth", pa.int64()),
            *((c, pa.bool_()) for c in ("is_top", "is_part")),
            *((c, pa.int64()) for c in ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
        ]
    )

    def of_block(rows: list[dict]) -> Iterator[tuple]:
        starts = [i for i, r in enumerate(rows) if not i or (r["s1"], r["s2"]) != (rows[i - 1]["s1"], rows[i - 1]["s2"])]
        for a, b in zip(starts, [*starts[1:], len(rows)], strict=True):
            seen = rows[0]["seen"] if a == 0 else -1
            follows = rows[0]["follows"] if b == len(rows) else -1
            yield from tree_nodes(rows[a:b], seen, follows, offset)

    def blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
        rows: list[dict] = []
        for part in parts:
            for row in part.to_pylist():
                if rows and (row["_part"], row["_block"]) != (rows[0]["_part"], rows[0]["_block"]):
                    yield rows
                    rows = []
                row["below"] = None if row["leaves"] is None else (row["children"], row["leaves"], row["saved"])
                rows.append(row)
        if rows:
            yield rows

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks(parts):
            yield from batches(schema, of_block(rows))

    return run


def segment_nodes(keys: DataFrame, offset: int, below: DataFrame | None, layout: Layout) -> DataFrame:
    """Nodes (as in NODES) of one segment of all conversations; figures of nodes in several blocks are merged."""
    spark = keys.sparkSession
    figures = ("children", "leaves", "saved")
    if below is None:
        keys = keys.withColumns({c: F.lit(None).cast("bigint") for c in figures})
    else:
        keys = keys.join(below, ["e1", "e2"], "left")
    order = ["s1", "s2", "key"]
    schema = ddl(keys, "_part bigint, _block bigint")
    sorted_keys = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    blocked = stored(sorted_keys.mapInArrow(_blocked(layout), schema), "keys")
    place = Window.orderBy("_part", "_block")  # a row per block
    ends = blocked.groupBy("_part", "_block").agg(F.min(F.struct(*order)).alias("a"), F.max(F.struct(*order)).alias("b"))
    beside = ends.withColumns({"x": F.lag("b").over(place), "y": F.lead("a").over(place)})
    shared = beside.mapInArrow(_neighbours, "_part bigint, _block bigint, seen int, follows int")
    of_block = ["_part", "_block"]
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = stored(
        blocked.join(shared, of_block)
        .repartition(tasks, *of_block)
        .sortWithinPartitions(*of_block, *order)
        .mapInArrow(_trees(offset), NODES),
        "nodes",
    )
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = (
        nodes.filter("is_part")
        .groupBy("node", "parent", "depth", "is_top", "is_part")
        .agg(
            F.min("conv_id").alias("conv_id"),
            F.lit(None).cast("bigint").alias("parent_conv_id"),
            *(F.sum(c).alias(c) for c in sums),
        )
    )
    return nodes.filter("not is_part").unionByName(merged)


# ---- ends


def _hashed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation to one hash per node."""
    schema = pa.schema([("node", pa.string()), ("ends_sha256", pa.string())])

    def rows() -> Iterator[tuple]:
        current, digest = None, None
        for part in parts:
            if not len(part):
                continue
            node, conv = part.column("node").to_numpy(zero_copy_only=False), part.column("conv_id").to_pylist()
            cuts = np.flatnonzero(np.r_[True, node[1:] != node[:-1], True])
            for a, b in zip(cuts, cuts[1:], strict=False):
                text = ",".join(map(str, conv[a:b])).encode()
                if node[a] == current:
                    digest.update(b"," + text)
                    continue
                if digest:
                    yield current, digest.hexdigest()
                current, digest = node[a], hashlib.sha256(text)
        if digest:
            yield current, digest.hexdigest()

    yield from batches(schema, rows())


def trie(conversations: DataFrame, layout: Layout | None = None) -> DataFrame:
    """The nodes of the trie of rebuilt `conversations` (conv_id, turn, role, text)."""
    layout = layout or Layout()
    convs, turns = rebuilt(numbered_turns(conversations))
    cut = stored(segments(convs, turns, layout), "segments")
    deepest = cut.agg(F.max("segment")).first()[0]
    found, below = [], None
    for number in range(deepest if deepest is not None else 0, -1, -1):
        keys = (
            cut.filter(F.col("segment") == number)
            .groupBy("s1", "s2", "key", "e1", "e2")
            .agg(F.any_value("words").alias("words"), F.count("*").alias("n"), F.min("conv_id").alias("least"))
        )
        nodes = stored(segment_nodes(keys, number * layout.segment_turns, below, layout), "nodes")
        if number:
            name = F.split("node", ":")
            lanes = (F.element_at(name, i).cast("bigint").alias(f"e{i - 1}") for i in (2, 3))
            below = nodes.filter("is_top").select(
                *lanes, *(F.col(c).alias(a) for c, a in (("n_children", "children"), ("n_leaves", "leaves"), ("saved_tokens", "saved")))
            )
            nodes = nodes.filter("not is_top")
        found.append(nodes)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.unionByName(more)

    # Parents in several blocks, or in the segment before, are looked up. The root has none.
    open_parent = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    parents = nodes.filter(F.col("is_part") | (F.col("depth") % layout.segment_turns == 0)).select(
        F.col("node").alias("parent"), F.col("conv_id").alias("_parent_conv")
    )
    asked = salted_lookup(nodes.filter(open_parent), parents, "parent", F.col("node"))
    nodes = (
        asked.withColumn("parent_conv_id", F.col("_parent_conv"))
        .drop("_parent_conv")
        .unionByName(nodes.filter(~open_parent))
    )
    ends = (
        cut.filter("is_last")
        .select(node_name(F.col("depth").cast("string"), F.col("e1").cast("string"), F.col("e2").cast("string")).alias("node"), "conv_id")
        .repartition("node")
        .sortWithinPartitions("node", "conv_id")
        .mapInArrow(_hashed, "node string, ends_sha256 string")
    )
    return nodes.join(ends, "node", "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


_SQL_CRC = """
    crc_table as (
      select list(list_reduce(list_prepend(b, range(8)),
        lambda c, step: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) t
      from range(256) r(b)),
    h as (
      select c, xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, list_transform(
          regexp_extract_all(hex(encode(c::varchar)), '..'), lambda x: ('0x' || x)::bigint)),
        lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) % 4 h
      from (select distinct conv_id c from conversations where conv_id is not null), crc_table)"""

ORACLE = rf"""
  with {_SQL_CRC},
    t as (
      select conv_id c, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) w,
        md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) x
      from conversations where conv_id is not null),
    own as (select c, list(struct_pack(x := x, w := w) order by turn nulls first, x) l from t group by c),
    r as (
      select o.c, coalesce(b.l, []).list_slice(1, h) || o.l.list_slice(h + 1, len(o.l)) l
      from own o join h using (c) left join own b on b.c = o.c - o.c % 20),
    p as (
      select c, d, d = len(l) ends, md5(list_transform(l.list_slice(1, d), lambda y: y.x)::varchar) node,
        case when d > 0 then md5(list_transform(l.list_slice(1, d - 1), lambda y: y.x)::varchar) end parent,
        case when d > 0 then l[d].w else 0 end w
      from r, unnest(range(len(l) + 1)) u(d)),
    n as (
      select node, d, any_value(parent) parent, min(c) conv_id, count(*) n_convs, any_value(w) w,
        sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) ends_sha256
      from p group by node, d),
    k as (select parent node, d - 1 d, count(*) n_children from n where d > 0 group by all),
    -- every node with all its ancestors, itself included, by its smallest member
    a as (
      select q.node, q.d, n.node below, (n.n_convs - 1) * n.w saved, k.node is null leaf
      from n join p q on q.c = n.conv_id and q.d <= n.d left join k on k.node = n.node and k.d = n.d),
    s as (select node, d, sum(saved)::bigint saved_tokens, count(*) filter (leaf) n_leaves from a group by node, d)
  select n.conv_id, n.d::bigint depth, f.conv_id parent_conv_id, n.n_convs::bigint n_convs,
    coalesce(n_children, 0)::bigint n_children, n_leaves::bigint n_leaves, saved_tokens, n.ends_sha256
  from n join s using (node, d) left join k using (node, d) left join n f on f.node = n.parent and f.d = n.d - 1
"""
