"""N-gram Jaccard join: MinHash bands propose pairs, full n-gram sets decide.

1. Each text's words (between ASCII white space, A to Z in lower case) give a set of five-word
   n-grams, a key of the whole set, and one hash per band. Band and row counts follow from the wanted
   recall at the threshold.
2. Texts with equal sets are one class, represented by its smallest id. Only classes go on.
3. Classes that share a band's hash form a bucket. Of buckets with the same members the first
   stays. Large buckets are cut into blocks, and each pair of blocks is compared on its own, so no
   task holds a bucket.
4. Texts of the classes in buckets are sent to them, and all pairs are compared on their full
   sets, each pair only in the first band it shares. A task returns one row per class: the number
   of documents it is linked with, and the smallest class it is connected with there. Pairs
   are never written out.
5. Connected components give the class of near duplicates.

Texts without words have no n-grams and no links. Texts of one to four words have one n-gram, all
their words. A NULL text is empty. Rows that repeat an id are documents of their own. Classes
are named by their smallest id (NULL if there is none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import salted_lookup, stored, table, whole_text
from mercato.llm.components import components
from mercato.llm.shingles import MinHash, bands_for, hash_words, shingles, text_groups


@dataclass(frozen=True)
class Join:
    words: int = 5
    threshold: float = 0.8
    recall: float = 0.999  # of pairs exactly at the threshold; others are found more surely
    block_rows: int = 400
    block_grams: int = 1_000_000  # of a block's sets together, on average
    broadcast_ids: int = 1_000_000  # 16-byte names of rows are broadcast up to this number


def set_key(grams: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(grams.tobytes())


def signatures(docs: DataFrame, join: Join) -> DataFrame:
    """(doc_id, digest, key, n_grams, bands) of each row of `docs` (doc_id, text).

    `digest` is the text's md5; the key of its set of n-grams is NULL without words.
    """
    bands, rows = bands_for(join.threshold, join.recall)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minhash = MinHash(bands, rows)
        for part in parts:
            keys, sizes, found = [], [], []
            for grams in sets_of(part.column("text"), join.words):
                keys.append(set_key(grams) if len(grams) else None)
                sizes.append(len(grams))
                found.append(minhash.band_hashes(grams) if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("digest"),
                    pa.array(keys, pa.string()),
                    pa.array(sizes, pa.int64()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["doc_id", "digest", "key", "n_grams", "bands"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_digest().alias("digest"), "text").mapInArrow(
        run, f"doc_id {kind}, digest string, key string, n_grams bigint, bands array<bigint>"
    )


def sets_of(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The n-gram set of each text."""
    for _, texts in text_groups(column):
        hashes, counts = hash_words(texts)
        for words in np.split(hashes, np.cumsum(counts)[:-1]):
            yield shingles(words, n)


def text_digest() -> Column:
    """What tells apart rows that share an id; NULL is as the empty text."""
    return F.md5(whole_text())


def row_name(doc_id: Column, digest: Column) -> Column:
    """16 bytes that name the rows of an id and a text."""
    return F.unhex(F.md5(F.concat_ws("|", digest, F.coalesce(doc_id.cast("string"), F.lit("")), doc_id.isNull().cast("string"))))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets."""
    n = len(sets)
    grams, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = counts > 1  # the others can't be common to two
    column = np.cumsum(shared) - 1
    at = shared[inverse]
    owner, column = owner[at], column[inverse[at]]
    total = np.zeros((n, n))
    width = max(1, 4_000_000 // n)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        block = np.zeros((n, min(width, int(shared.sum()) - start)), dtype=np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        total += block @ block.T
    np.fill_diagonal(total, [len(s) for s in sets])
    return total


def links(sets: list[np.ndarray], bands: np.ndarray, own: np.ndarray, band: int, threshold: float) -> np.ndarray:
    """Which pairs of a group are linked, as a symmetric matrix; only pairs that belong to `band`.

    `own` says which of the group's two blocks a set is from; if there are two, only pairs
    between them count, as the pairs within are compared elsewhere.
    """
    n = len(sets)
    wanted = ~np.eye(n, dtype=bool)
    if len(np.unique(own)) > 1:
        wanted &= own[:, None] != own[None, :]
    for earlier in range(band):
        wanted &= bands[:, earlier][:, None] != bands[:, earlier][None, :]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    wanted &= np.minimum.outer(sizes, sizes) >= threshold * np.maximum.outer(sizes, sizes) - 1e-9
    if not wanted.any():
        return wanted
    used = np.flatnonzero(wanted.any(axis=1))
    linked = np.zeros((n, n), dtype=bool)
    both = common_counts([sets[i] for i in used])
    either = np.add.outer(sizes[used], sizes[used]) - both
    linked[np.ix_(used, used)] = both >= threshold * either - 1e-9
    return linked & wanted


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index of each row's component."""
    root = np.arange(len(linked))
    while True:
        near = np.where(linked, root[None, :], len(root)).min(axis=1)
        new = np.minimum(root, near)
        new = new[new]
        if (new == root).all():
            return root
        root = new


GROUP = ["band", "hash", "low", "high"]


def _compare(join: Join):
    """Rows sorted by group to (key, links, root) of the classes that have links there."""

    def group(name: tuple | None, rows: list[tuple]) -> Iterator[tuple]:
        if name is None or (name[2] != name[3] and len({r[2] for r in rows}) == 1):
            return  # of two blocks one is empty; pairs within the other are compared on their own
        rows.sort(key=lambda r: r[0])
        kept, sets = [], []
        for row, grams in zip(rows, sets_of(pa.array([r[4] for r in rows], pa.string()), join.words), strict=True):
            key = row[0]
            if not (kept and kept[-1][0] == key):
                kept.append(row)
                sets.append(grams)
        if len(kept) < 2:
            return
        bands = np.array([r[1] for r in kept], dtype=np.int64)
        own = np.array([r[2] for r in kept])
        copies = np.array([r[3] for r in kept], dtype=np.int64)
        linked = links(sets, bands, own, kept[0][5], join.threshold)
        root = _roots(linked)
        for i in np.flatnonzero(linked.any(axis=1)):
            yield kept[i][0], int(copies[linked[i]].sum()), kept[root[i]][0]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for whole in parts:
            for some, texts in text_groups(whole.column("text")):
                part = whole.slice(some.start, some.stop - some.start)
                out: list[tuple] = []
                groups = zip(*(part.column(c).to_pylist() for c in GROUP), strict=True)
                columns = [part.column(c).to_pylist() for c in ("key", "bands", "own", "copies")]
                for name, row in zip(groups, zip(*columns, texts, part.column("band").to_pylist(), strict=True), strict=True):
                    if name != current:
                        out += group(current, rows)
                        current, rows = name, []
                    rows.append(row)
                if out:
                    yield _linked(out)
        if out := list(group(current, rows)):
            yield _linked(out)

    return run


def _linked(rows: list[tuple]) -> pa.RecordBatch:
    key, links, root = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(key, pa.string()), pa.array(links, pa.int64()), pa.array(root, pa.string())],
        names=["key", "links", "root"],
    )


def near_duplicates(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """(doc_id, digest, class_id, first_digest, n_links, n_equal, n_grams) of each row of `docs` (doc_id, text).

    The first document of a class is that with the smallest id (of equal ids, the smallest
    digest): its id is `class_id`, its digest `first_digest`. `n_links` counts the other documents with a similarity of at least the threshold, equal ones
    included; `n_equal` those with the same set of n-grams, the document itself included.
    """
    join = join or Join()
    signed = stored(signatures(docs, join), "signatures")
    classes = stored(
        signed.filter("key is not null")
        .groupBy("key")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("first"),
            F.count("*").alias("copies"),
            F.any_value("n_grams").alias("n_grams"),
            F.any_value("bands").alias("bands"),
        ),
        "classes",
    )
    placed = classes.select("key", "first", "copies", "n_grams", "bands", F.posexplode("bands").alias("band", "hash"))
    buckets = (
        placed.groupBy("band", "hash")
        .agg(
            F.count("*").alias("n"),
            F.sum("n_grams").alias("grams"),
            F.bit_xor(F.xxhash64("key")).alias("x"),
            F.bit_xor(F.xxhash64(F.lit("member"), "key")).alias("y"),
        )
        .filter("n > 1")
        .groupBy("n", "x", "y")  # the same members: one bucket will do
        .agg(F.min(F.struct("band", "hash")).alias("first"), F.max("grams").alias("grams"))
        .select(
            "first.band",
            "first.hash",
            F.greatest(F.ceil(F.col("n") / join.block_rows), F.ceil(F.col("grams") / join.block_grams))
            .cast("int")
            .alias("blocks"),
        )
    )
    block = F.pmod(F.xxhash64(F.lit("block"), "key"), F.col("blocks")).cast("int")
    members = stored(
        placed.join(buckets, ["band", "hash"])
        .withColumn("own", block)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .select(*GROUP, "own", "key", "bands", "copies", row_name(F.col("first.doc_id"), F.col("first.digest")).alias("_row")),
        "members",
    )
    asked = members.select("_row").distinct()
    few = asked.count() <= join.broadcast_ids
    # Rows that repeat an id and a text bring it once.
    texts = (
        docs.select(row_name(F.col("doc_id"), text_digest()).alias("_row"), "text")
        .join(F.broadcast(asked) if few else asked, "_row", "left_semi")
        .groupBy("_row")
        .agg(F.any_value("text").alias("text"))
    )
    linked = stored(
        members.join(texts, "_row")
        .select(*GROUP, "own", "key", "bands", "copies", "text")
        .repartition(*GROUP)
        .sortWithinPartitions(*GROUP)
        .mapInArrow(_compare(join), "key string, links bigint, root string"),
        "linked",
    )
    roots = components(linked.select(F.col("key").alias("a"), F.col("root").alias("b")))
    rooted = roots.withColumnRenamed("node", "key").join(classes.select("key", "first"), "key")
    named = rooted.groupBy("root").agg(F.min("first").alias("class_first"))
    counts = linked.groupBy("key").agg(F.sum("links").alias("links"))
    # Classes of a single document without links need no lookup.
    several = (
        classes.select("key", "first", "copies")
        .join(counts, "key", "left")
        .filter("copies > 1 or links is not null")
        .join(rooted.select("key", "root"), "key", "left")
    )
    known = salted_lookup(several, named, "root", F.col("key")).select(
        "key",
        F.coalesce("class_first", "first").alias("_class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
        F.col("copies").alias("_copies"),
    )
    rows = signed.select("doc_id", "digest", "key", "n_grams")
    alone = F.col("_copies").isNull()
    return salted_lookup(rows, known, "key", F.struct("doc_id", "digest")).select(
        "doc_id",
        "digest",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_class.doc_id")).alias("class_id"),
        F.when(alone, F.col("digest")).otherwise(F.col("_class.digest")).alias("first_digest"),
        F.coalesce("_links", F.lit(0)).alias("n_links"),
        F.coalesce("_copies", F.lit(1)).alias("n_equal"),
        "n_grams",
    )


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", "n_equal", "n_grams")


def one_of_each_class(docs: DataFrame, join: Join | None = None) -> DataFrame:
    """The rows of `docs` (doc_id, text, ...) without those that a near duplicate stands for.

    Rows without words all stay. Of rows that repeat the first document of a class, one stays.
    """
    join = join or Join()
    found = stored(near_duplicates(docs.select("doc_id", "text"), join), "near")
    first = F.expr("doc_id <=> class_id and digest = first_digest")
    name = row_name(F.col("doc_id"), F.col("digest")).alias("_name")
    gone = found.filter(~first).select(name).distinct()
    repeated = found.filter(first & (F.col("n_equal") > 1)).select(name).groupBy("_name").count()
    repeated = repeated.filter("count > 1").select("_name")
    # The row is kept in one column, so that its columns may have any names.
    keyed = docs.select(F.struct("*").alias("_row"), row_name(F.col("doc_id"), text_digest()).alias("_name"))

    def by_row(rows: DataFrame, how: str) -> DataFrame:
        few = rows.count() <= join.broadcast_ids
        return keyed.join(F.broadcast(rows) if few else rows, "_name", how)

    keyed = by_row(gone, "left_anti")
    if not repeated.isEmpty():
        rows = by_row(repeated, "left_semi").groupBy("_name").agg(F.any_value("_row").alias("_row"))
        keyed = by_row(repeated, "left_anti").unionByName(rows)
    return keyed.select("_row.*")


# All pairs that share an n-gram, and the closure of their links.
ORACLE = """
  with recursive w as (
      select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') w from documents),
    g as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) g from w),
    s as (select doc_id, unnest(g) h from g),
    sizes as (select doc_id, len(g) n, list_sort(g) g from g),
    equal as (select g, min(doc_id) first_id, count(*) copies from sizes where n > 0 group by g),
    member as (select doc_id, n, first_id, copies from sizes left join equal using (g)),
    reps as (select s.doc_id, h from s join member m on m.doc_id = s.doc_id and m.first_id = m.doc_id),
    shared as (select a.doc_id a, b.doc_id b, count(*) c from reps a join reps b on a.h = b.h and a.doc_id < b.doc_id
      group by all),
    near as (select a, b from shared join member x on x.doc_id = a join member y on y.doc_id = b
      where 5 * c >= 4 * (x.n + y.n - c)),
    ways as (select a, b from near union all select b, a from near),
    reach(a, b) as (select a, b from ways union select r.a, e.b from reach r join ways e on e.a = r.b),
    root as (select a, least(a, min(b)) root from reach group by a),
    linked as (select a, sum(copies) links from ways join member m on m.doc_id = b group by a)
  select m.doc_id, coalesce(root, first_id, m.doc_id) class_id,
    (coalesce(links, 0) + coalesce(copies, 1) - 1)::bigint n_links, coalesce(copies, 1)::bigint n_equal,
    n::bigint n_grams
  from member m left join root on root.a = first_id left join linked l on l.a = first_id
"""
