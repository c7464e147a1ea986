"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a row draws an exponential time -ln(u) / weight for every child, u being hashed
from the row's key and the child's name, and descends into the child whose time is least. A
child thus gets rows in proportion to its weight, and a changed weight moves rows only into or
out of the subtree that holds it.

A shard that is added later keeps the draws of all others as they are: it races with the regions
by a draw of its own, in the name of the weight it adds, and what it wins goes straight to it. So
growth moves rows into the new shard and nowhere else.

Slots number the rows of a shard without gaps, in order of a hash of the row. A shard's hash range
is cut into chunks of about `rows_per_chunk` rows; counts per chunk give offsets, so no shard is
sorted in one task. Equal rows are counted before the shuffle and numbered from their count, so
a row that repeats without end isn't gathered either. The result doesn't depend on the chunks.

NULL keys count as the empty text, NULL texts as 16 bytes and checksum 0. Only the named columns
are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import hex_number, id_text, table

SHARDS = 40
HEAD_BYTES = 16


@dataclass(frozen=True)
class Shard:
    shard: int
    region: str
    rack: str
    weight: float = 1.0


@dataclass(frozen=True)
class Tree:
    """`shards` make up the tree; `added` came later and compete by their own draws."""

    shards: tuple[Shard, ...]
    added: tuple[Shard, ...] = ()


def even_tree(count: int, base: int = SHARDS, regions: int = 4, racks: int = 2) -> Tree:
    """`count` equal shards; those from `base` on are added to the tree of the first `base`."""

    def place(i: int) -> Shard:
        region = i % regions
        return Shard(i, f"r{region}", f"r{region}/k{i // regions % racks}")

    made = [place(i) for i in range(count)]
    return Tree(tuple(made[:base]), tuple(made[base:]))


def _child(name: str, weight: float, child: int | None, shard: int | None) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(float(weight)).alias("weight"),
        F.lit(child).cast("int").alias("child"),
        F.lit(shard).cast("int").alias("shard"),
    )


def _winner(key: Column, children: Column) -> Column:
    """The child with the least time."""

    def time(c: Column) -> Column:
        draw = hex_number(F.md5(F.concat(key, F.lit("|"), c["name"])), 1, 13)
        return F.struct(
            (-F.log((draw + 0.5) / float(2**52)) / c["weight"]).alias("time"),
            c["name"].alias("name"),
            c["child"].alias("child"),
            c["shard"].alias("shard"),
        )

    return F.array_min(F.transform(children, time))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key that is given as text."""
    regions = sorted({s.region for s in tree.shards})
    racks = [sorted({s.rack for s in tree.shards if s.region == r}) for r in regions]
    names = [k for own in racks for k in own]
    weight = lambda part: sum(s.weight for s in part)
    top = F.array(
        *(_child(r, weight(s for s in tree.shards if s.region == r), i, None) for i, r in enumerate(regions)),
        *(_child(f"added/s{s.shard}", s.weight, None, s.shard) for s in tree.added),
    )
    rack_table = F.array(
        *(
            F.array(*(_child(k, weight(s for s in tree.shards if s.rack == k), names.index(k), None) for k in own))
            for own in racks
        )
    )
    leaf_table = F.array(
        *(
            F.array(*(_child(f"{k}/s{s.shard}", s.weight, None, s.shard) for s in tree.shards if s.rack == k))
            for k in names
        )
    )
    region = _winner(key, top)
    rack = _winner(key, F.element_at(rack_table, region["child"] + 1))
    leaf = _winner(key, F.element_at(leaf_table, rack["child"] + 1))
    return F.coalesce(region["shard"], leaf["shard"])


def with_slots(rows: DataFrame, columns: list[str], rows_per_chunk: int = 2000) -> DataFrame:
    """`rows` with `slot`: 0, 1, ... within `shard`, in order of a hash of `columns`."""
    total = rows.select("shard").count()
    chunks = max(1, math.ceil(total / SHARDS / rows_per_chunk))
    equal = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    place = hex_number(F.md5(F.concat_ws("|", F.lit("slot"), *equal)), 1, 8)
    counted = (
        rows.groupBy("shard", *[c for c in rows.columns if c != "shard"])
        .agg(F.count("*").alias("_copies"))
        .withColumn("_place", place)
        .withColumn("_chunk", F.shiftright(F.col("_place") * chunks, 32))
    )
    sizes = counted.groupBy("shard", "_chunk").agg(F.sum("_copies").alias("_rows"))
    earlier = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    before = (
        Window.partitionBy("shard", "_chunk")
        .orderBy("_place", *columns)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        counted.withColumn("_before", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
        .join(offsets, ["shard", "_chunk"])
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
        .withColumn("slot", F.col("_offset") + F.col("_before") + F.col("_copy"))
        .select(*rows.columns, "slot")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = id_text("doc_id")
    text = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + HEAD_BYTES).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, even_tree(SHARDS)).alias("shard"),
        shard_of(key, even_tree(SHARDS + 1)).alias("grown_shard"),
    )
    return with_slots(rows, ["doc_id", "size", "text_crc32"])


def _sql_draw(name: str, weight: str) -> str:
    return f"-ln((('0x' || substr(md5(key || '|' || {name}), 1, 13))::bigint + 0.5) / {float(2**52)}) / {weight}"


def _sql_levels(tree: Tree, alias: str) -> str:
    """Each level's winner as a DuckDB query over `keys`, ending in (key, shard)."""
    values = ", ".join(f"('{s.region}', '{s.rack}', {s.shard}, {s.weight})" for s in tree.shards)
    added = "".join(
        f" union all select key, null, {s.shard}, {_sql_draw(f"'added/s{s.shard}'", str(s.weight))} from keys"
        for s in tree.added
    )
    return f"""
    tree_{alias}(region, rack, shard, weight) as (values {values}),
    regions_{alias} as (select region, sum(weight) weight from tree_{alias} group by region),
    racks_{alias} as (select region, rack, sum(weight) weight from tree_{alias} group by region, rack),
    top_{alias} as (
      select key, arg_min(struct_pack(region := region, shard := shard), t) w from (
        select key, region, null::int shard, {_sql_draw('region', 'weight')} t from keys, regions_{alias}{added}
      ) group by key),
    rack_{alias} as (
      select key, arg_min(rack, {_sql_draw('rack', 'weight')}) rack
      from top_{alias} join racks_{alias} r on r.region = w.region group by key),
    leaf_{alias} as (
      select key, arg_min(shard, {_sql_draw("rack || '/s' || shard", 'weight')}) shard
      from rack_{alias} join tree_{alias} using (rack) group by key),
    shard_{alias} as (
      select key, coalesce(w.shard, l.shard) shard from top_{alias} left join leaf_{alias} l using (key))"""


# CRC-32 by its table, which follows from the reversed polynomial.
_SQL_CRC = """
    crc_table as (
      select list(list_reduce(list_prepend(b, range(8)),
        lambda c, step: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) t
      from range(256) r(b)),
    checked as (
      select doc_id, bytes, xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, list_transform(
          regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) crc
      from (select doc_id, text, octet_length(encode(coalesce(text, ''))) bytes from documents), crc_table)"""

ORACLE = f"""
  with {_SQL_CRC},
    keys as (select distinct coalesce(cast(doc_id as varchar), '') key from documents),
    {_sql_levels(even_tree(SHARDS), "now")},
    {_sql_levels(even_tree(SHARDS + 1), "grown")},
    placed as (
      select doc_id, bytes + {HEAD_BYTES} size, crc text_crc32, n.shard, g.shard grown_shard
      from checked c
      join shard_now n on n.key = coalesce(cast(doc_id as varchar), '')
      join shard_grown g on g.key = n.key)
  select doc_id, size::bigint size, text_crc32::bigint text_crc32, 'key' law, shard::int shard,
    grown_shard::int grown_shard,
    row_number() over (partition by shard order by
      ('0x' || substr(md5('slot|' || coalesce(cast(doc_id as varchar), '') || '|' || size || '|' || text_crc32), 1, 8))
        ::bigint, doc_id, size, text_crc32) - 1 slot
  from placed
"""
