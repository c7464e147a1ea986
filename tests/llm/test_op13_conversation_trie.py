from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from mercato.llm.op13_conversation_trie import Layout, Node, insert, shared_turns, tree_nodes, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SMALL = Layout(segment_turns=3, block_bytes=10**9, block_keys=2)
TINY = Layout(segment_turns=1, block_bytes=20, block_keys=10**9)


def remainder(c):
    return abs(c) % 20 * (1 if c >= 0 else -1)


def digest(turn):
    role, text = turn
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def expected(rows):
    """Brute force: the nodes of (conv_id, turn, role, text), sorted."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, digest((role or "", text or "")), (role or "", text or "")))
    original = {c: [t[3] for t in sorted(own)] for c, own in convs.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % 4
        turns = tuple(original.get(c - remainder(c), [])[:h] + own[h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(own) - 1) * words
    return sorted(
        (
            (
                min(own),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(own),
                children.get(path, 0),
                leaves[path],
                saved[path],
                hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
            )
            for path, own in members.items()
        ),
        key=str,
    )


def got(spark, rows, layout=None):
    return sorted(map(tuple, trie(spark.createDataFrame(rows, SCHEMA), layout).collect()), key=str)


def random_rows(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-50, 150), convs):
        for t in range(rng.choice([1, 1, 2, 3, 4, 6, 11])):
            rows.append((c, t, rng.choice(["u", "b"]), rng.choice(["", "a", "a b", " a\tb c "]) if t else "hi"))
    return rows


@pytest.mark.parametrize("layout", [None, SMALL, TINY])
def test_against_brute_force(spark, layout):
    rows = random_rows(1)
    assert got(spark, rows, layout) == expected(rows)


@pytest.mark.parametrize("layout", [None, SMALL])
def test_odd_rows(spark, odd_dir, layout):
    conversations = spark.read.parquet(f"{odd_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = expected([tuple(r) for r in conversations.collect()])
    assert sorted(map(tuple, trie(conversations, layout).collect()), key=str) == want


def test_a_third_of_the_rows_in_one_conversation_and_a_third_of_equal_ones(spark):
    rows = [(7, t, "u", f"long {t % 5}") for t in range(400)]
    rows += [(1000 + 20 * c + 19, t, "u", f"copy {t}") for c in range(100) for t in range(4)]
    rows += random_rows(2)
    layout = Layout(segment_turns=150, block_bytes=10**9, block_keys=7)
    assert got(spark, rows, layout) == expected(rows)


def test_small_table(spark, result):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert sorted(map(tuple, result("op13")), key=str) == expected([tuple(r) for r in rows.collect()])


def test_only_conversations_without_turns(spark):
    """All their turns come from a base that isn't there."""
    empty = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4][:3]
    rows = [(c, 0, "u", "x") for c in empty]
    assert got(spark, rows) == expected(rows)
    assert len(got(spark, rows)) == 1


def test_layouts_grow():
    root = Node(b"")
    rooms = set()
    for byte in random.Random(1).sample(range(256), 256):
        root.put(byte, Node(bytes([byte])))
        rooms.add(root.room)
        assert root.find(byte).prefix == bytes([byte])
    assert rooms == {4, 16, 48, 256}
    assert all(root.find(b).prefix == bytes([b]) for b in range(256))
    other = Node(b"new")
    root.put(3, other)
    assert root.find(3) is other


def test_insert_in_any_order():
    rng = random.Random(4)
    keys = list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(8))) for _ in range(200)})
    root = None
    for i, key in enumerate(keys):
        root = insert(root, key, i)
    found, stack = {}, [(root, b"")]
    while stack:
        node, above = stack.pop()
        path = above + node.prefix
        if node.end is not None:
            found[path] = node.end
        for byte in range(256):
            child = node.find(byte)
            if child is not None:
                stack.append((child, path + bytes([byte])))
    assert found == {key: i for i, key in enumerate(keys)}


def test_shared_turns():
    key = bytes(range(48))
    assert shared_turns((0, 0, key), (0, 0, key[:32])) == 2
    assert shared_turns((0, 0, key), (0, 0, key[:31] + b"\xff" + key[32:])) == 1
    assert shared_turns((0, 0, key), (0, 1, key)) == -1
    assert shared_turns(None, (0, 0, key)) == -1


def test_deeply_nested_keys_need_no_recursion():
    ids = [hashlib.md5(b"%d" % i).digest() for i in range(3000)]
    rows, key = [], b""
    for i in range(3000):
        key += ids[i]
        if i % 2:
            rows.append({"key": key, "words": [1] * (i + 1), "n": 1, "least": i, "below": None, "s1": 0, "s2": 0})
    nodes = list(tree_nodes(rows[:1100], -1, -1, 0))
    assert len(nodes) == 2201
