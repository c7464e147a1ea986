"""Mixing sources to target weights by temperature.

Shares of tokens per source are raised to an exponent between 0 (all sources alike) and 1 (as they
are) and normalised. The exponent is found by section on a grid: the largest whose weights still have
the wanted entropy, but none so small that a source would be repeated more often than allowed. Each
step is one small aggregation over the table of sources, which may be of any size.

The weights are then realised as token budgets, to the nearest token; they are doubles, shown in whole
billionths. A source's documents have a fixed random order (by a
hash). Its budget takes whole passes over them and, of the last pass, documents while the tokens before
them are below what is left. With `whole`, the largest source's budget is what it has and no other's is
less, so every document is read however small its source's weight is. The stream is cut into blocks of about `block_tokens` tokens, each with
every source's weight, and each block is permuted by another hash.

Running sums per source come from chunks of the hash range, so no source is sorted in one task; the
result doesn't depend on the chunks. Equal rows (same id, source and tokens) are counted before any
shuffle. Texts are never shuffled: `mixed` finds per source the number of passes and the last hash that
is taken, and looks both up.

Tokens are words between ASCII white space. NULL and empty texts have none and cost nothing; a source
without tokens has weight 0 and its documents are taken once. A NULL source is a source of its
own, a NULL id counts as the empty text. If even exponent 1 repeats too often, it is used. An empty table
gives no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.llm.common import hex_number, id_text, salted_lookup, stored, table, whole_text

GRID = 2**20  # the exponent is a multiple of 1 / GRID
BILLION = 1_000_000_000  # weights are shown in whole billionths
PLACES = 2**48


@dataclass(frozen=True)
class Mix:
    """`budget` is in tokens; None means all there are, or with `whole` as many as read every source
    at least once. `entropy` is a share of the entropy of equal weights."""

    entropy: float | None = 0.95
    max_repeats: float | None = 4.0
    budget: int | None = None
    whole: bool = False
    block_tokens: int = 500_000
    rows_per_chunk: int = 2000
    broadcast_sources: int = 100_000
    seed: int = 1


def n_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _place(mix: Mix) -> Column:
    return hex_number(
        F.md5(F.concat_ws("|", F.lit(f"mix{mix.seed}"), id_text("_id"), F.col("_tokens").cast("string"))), 1, 12
    )


def prepared(docs: DataFrame, doc_id: str, source: str, text: str, mix: Mix) -> DataFrame:
    """`docs` with `_id`, `_source`, `_tokens` and `_place`, which say where a row stands."""
    return (
        docs.withColumn("_id", F.col(doc_id))
        .withColumn("_source", F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")))
        .withColumn("_tokens", n_tokens(whole_text(text)))
        .withColumn("_place", _place(mix))
    )


def _measures(sources: DataFrame, exponents: list[int], budget: int, mix: Mix) -> dict[int, tuple[float, float, float]]:
    """For each exponent: the sum of powers, the entropy, and how often a source is read at most."""
    power = F.pow("_share", F.col("k") / float(GRID))
    rows = (
        sources.filter("_total > 0")
        .withColumn("k", F.explode(F.array(*(F.lit(k) for k in exponents))))
        .groupBy("k")
        .agg(
            F.sum(power).alias("z"),
            F.sum(power * F.log("_share")).alias("s"),
            F.max(power / F.col("_total")).alias("high"),
            F.min(power / F.col("_total")).alias("low"),
        )
        .collect()
    )
    found = {}
    for r in rows:
        entropy = math.log(r["z"]) - r["k"] / GRID * r["s"] / r["z"]
        repeats = r["high"] / r["low"] if mix.whole else budget * r["high"] / r["z"]
        found[r["k"]] = (r["z"], entropy, repeats)
    return found


def _first(sources: DataFrame, budget: int, mix: Mix, holds, none: int) -> int:
    """The smallest exponent below `none` for which `holds`, which stays true from then on; else `none`."""
    low, high = -1, none
    while high - low > 1:
        step = max(1, (high - low) // 32)
        points = [*range(low + step, high, step)]
        measured = _measures(sources, points, budget, mix)
        true = [k for k in points if holds(*measured[k][1:])]
        high = true[0] if true else high
        low = max([low, *(k for k in points if k < high)])
    return high


def exponent(sources: DataFrame, count: int, budget: int, mix: Mix) -> int:
    """The least tempered weights that have the entropy; without one, the most tempered ones that the
    limit of repeats allows. The limit comes first; without either, weights are as they are."""
    chosen = GRID if mix.entropy is None and mix.max_repeats is None else 0
    if mix.entropy is not None:
        least = mix.entropy * math.log(count)
        # The last that has the entropy is the one before the first that hasn't.
        above = _first(sources, budget, mix, lambda entropy, _: entropy < least - 1e-12, GRID + 1)
        chosen = max(0, above - 1)
    if mix.max_repeats is not None:
        most = mix.max_repeats + 1e-12
        chosen = max(chosen, _first(sources, budget, mix, lambda _, repeats: repeats <= most, GRID))
    return chosen


def weighted_sources(rows: DataFrame, mix: Mix) -> DataFrame:
    """(_source, _total, _docs, weight, quota): weights in billionths, budgets in tokens. Stored."""
    totals = stored(
        rows.groupBy("_source").agg(F.sum("_tokens").alias("_total"), F.count("*").alias("_docs")), "sources"
    )
    tokens, count = totals.agg(
        F.coalesce(F.sum("_total"), F.lit(0)), F.count_if(F.col("_total") > 0)
    ).first()
    if not tokens:
        zero = F.lit(0).cast("bigint")
        return totals.withColumns({"weight": zero, "quota": zero})
    sources = totals.withColumn("_share", F.col("_total") / float(tokens))
    budget = tokens if mix.budget is None else mix.budget
    k = exponent(sources, count, budget, mix)
    z = _measures(sources, [k], budget, mix)[k][0]
    exact = F.when(F.col("_total") > 0, F.pow("_share", F.lit(k / GRID)) / z).otherwise(0.0)
    weighted = sources.withColumn("weight", F.round(exact * float(BILLION)).cast("bigint"))
    if mix.whole:
        # The largest source is read once; how often another is follows from its size.
        largest = totals.agg(F.max("_total")).first()[0]
        reads = F.pow(F.lit(float(largest)) / F.col("_total"), F.lit(1 - k / GRID))
        more = F.floor(reads * F.col("_total")).cast("bigint")
        quota = F.when(F.col("_total") > 0, F.greatest(more, F.col("_total"))).otherwise(F.lit(0).cast("bigint"))
    else:
        quota = F.round(exact * float(budget)).cast("bigint")
    return stored(weighted.withColumn("quota", quota).drop("_share"), "weights")


def _with_before(rows: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """Distinct rows with `_copies`, `_before` (tokens of the source that come earlier) and the source's columns."""
    counted = rows.groupBy("_id", "_source", "_tokens", "_place").agg(F.count("*").alias("_copies"))
    chunks = F.ceil(F.col("_docs") / mix.rows_per_chunk)
    known = sources.withColumn("_chunks", chunks.cast("bigint"))
    placed = _look_up(counted, known, mix).withColumn(
        "_chunk", F.floor(F.col("_place") / F.lit(float(PLACES)) * F.col("_chunks")).cast("bigint")
    )
    tokens = F.col("_tokens") * F.col("_copies")
    sizes = placed.groupBy("_source", "_chunk").agg(F.sum(tokens).alias("_size"))
    earlier = Window.partitionBy("_source").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_source", "_chunk", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    before = (
        Window.partitionBy("_source", "_chunk")
        .orderBy("_place", "_id", "_tokens")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("_inner", F.coalesce(F.sum(tokens).over(before), F.lit(0)))
        .join(offsets, ["_source", "_chunk"])
        .withColumn("_before", F.col("_offset") + F.col("_inner"))
        .drop("_inner", "_offset", "_chunk", "_chunks")
    )


def _look_up(rows: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """Join the table of sources, which is broadcast if it is small."""
    if sources.count() <= mix.broadcast_sources:
        return rows.join(F.broadcast(sources), "_source")
    return salted_lookup(rows, sources, "_source", F.col("_place"), salts=32)


def _full() -> Column:
    """Whole passes over a source."""
    return F.expr("if(_total > 0, quota div _total, 1)")


def _rest() -> Column:
    """Tokens that are left for the last pass."""
    return F.expr("if(_total > 0, quota % _total, 0)")


def schedule(rows: DataFrame, sources: DataFrame, mix: Mix) -> DataFrame:
    """One row per copy of a prepared row: `epoch`, `block`, and `slot` within the block."""
    placed = _with_before(rows, sources, mix)
    budget = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    blocks = max(1, round(budget / mix.block_tokens))
    passes = _full() + F.when(F.col("_before") < _rest(), 1).otherwise(0)
    key = F.md5(
        F.concat_ws("|", F.lit(f"block{mix.seed}"), *(F.col(c).cast("string") for c in ("block", "epoch", "_place")))
    )
    in_block = (
        Window.partitionBy("block")
        .orderBy("_key", "_id", "_source", "_tokens", "epoch")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    position = "cast(cast(epoch as decimal(10,0)) * cast(_total as decimal(18,0)) + _before as decimal(28,0))"
    # Documents of sources without a budget are spread by their hash.
    block = F.when(
        F.col("quota") > 0, F.expr(f"{position} * cast({blocks} as decimal(10,0)) div cast(quota as decimal(20,0))")
    ).otherwise(F.expr(f"cast(_place as decimal(16,0)) * cast({blocks} as decimal(10,0)) div {PLACES}"))
    return (
        placed.withColumn("_passes", passes)
        .filter("_passes > 0")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_passes") - 1)))
        .withColumn("block", F.least(block.cast("bigint"), F.lit(blocks - 1)))
        .withColumn("_key", key)
        .withColumn("_first", F.coalesce(F.sum("_copies").over(in_block), F.lit(0)))
        .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
        .withColumn("slot", F.col("_first") + F.col("_copy"))
    )


def mixed(docs: DataFrame, mix: Mix, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """`docs`, each row as often as the mixture reads it (repeated or left out), columns as before."""
    # The row is kept in one column, so that its columns may have any names.
    asked = (F.col(f"`{c}`").alias(name) for c, name in ((doc_id, "doc_id"), (source, "source"), (text, "text")))
    rows = prepared(docs.select(F.struct("*").alias("_row"), *asked), "doc_id", "source", "text", mix)
    keys = rows.select("_id", "_source", "_tokens", "_place")
    sources = weighted_sources(keys, mix)
    last = (
        _with_before(keys, sources, mix)
        .filter(F.col("_before") < _rest())
        .groupBy("_source")
        .agg(F.max("_place").alias("_last"))
    )
    reads = stored(sources.join(last, "_source", "left").select("_source", _full().alias("_full"), "_last"), "reads")
    times = F.col("_full") + F.when(F.col("_place") <= F.col("_last"), 1).otherwise(0)
    return (
        _look_up(rows, reads, mix)
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times.cast("int"))))
        .select("_row.*")
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = Mix()
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    rows = stored(
        prepared(docs, "doc_id", "source", "text", mix).select("_id", "_source", "_tokens", "_place"), "places"
    )
    sources = weighted_sources(rows, mix)
    return schedule(rows, sources, mix).select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_source") != "n", F.substring("_source", 2, 2**31 - 1)).alias("source"),
        F.col("_tokens").alias("n_tokens"),
        "weight",
        "epoch",
        "block",
        "slot",
    )


def _oracle(mix: Mix) -> str:
    def bisect(name: str, measure: str, none: int) -> str:
        """The smallest exponent below `none` for which `measure` holds, by halving."""
        return f"""
    {name}(low, high) as (
      select -1, {none} union all
      select case when ok then low else mid end, case when ok then mid else high end from (
        select low, high, mid, {measure} ok from (
          select low, high, mid, list_sum(w) z, w, p, t, n, budget from (
            select low, high, (low + high) // 2 mid, p, t, n, budget,
              list_transform(p, lambda x: pow(x, ((low + high) // 2) / {float(GRID)})) w
            from {name}, lists where high - low > 1))))"""

    entropy = f"ln(z) - mid / {float(GRID)} * list_sum(list_transform(w, lambda x, i: x * ln(p[i]))) / z"
    repeats = "budget * list_max(list_transform(w, lambda x, i: x / t[i])) / z"
    return f"""
  with recursive rows as (
      select doc_id, source, n_tokens, ('0x' || substr(md5('mix{mix.seed}|' || coalesce(cast(doc_id as varchar), '')
        || '|' || n_tokens), 1, 12))::bigint place
      from (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) n_tokens
        from documents)),
    totals as (select source, sum(n_tokens)::bigint total from rows group by source),
    lists as (select list(total / (select sum(total) from totals)::double order by total) p, list(total order by total) t,
      count(*) n, sum(total)::bigint budget from totals where total > 0),
    {bisect("poorer", f"({entropy}) < {mix.entropy} * ln(n) - 1e-12", GRID + 1)},
    {bisect("rarer", f"({repeats}) <= {mix.max_repeats} + 1e-12", GRID)},
    chosen as (select greatest(0, (select min(high) from poorer) - 1, (select min(high) from rarer)) k),
    powers as (select source, total, budget, case when total > 0
        then pow(total / budget::double, k / {float(GRID)}) else 0 end w from totals, lists, chosen),
    weights as (select source, total, budget, w / (select sum(w) from powers) exact from powers),
    quotas as (select source, total, round(exact * {float(BILLION)})::bigint weight,
      round(exact * budget::double)::bigint quota from weights),
    ordered as (select r.*, total, weight, quota, coalesce(sum(n_tokens) over (partition by r.source
        order by place, doc_id, n_tokens rows between unbounded preceding and 1 preceding), 0)::bigint before
      from rows r join quotas q on r.source is not distinct from q.source),
    passes as (select *, case when total > 0 then quota // total else 1 end
      + case when total > 0 and before < quota % total then 1 else 0 end passes from ordered),
    copies as (select *, unnest(range(passes::bigint)) epoch from passes),
    blocked as (select *, least(n_blocks - 1, case when quota > 0
        then ((epoch::hugeint * total + before) * n_blocks // quota)::bigint
        else (place::hugeint * n_blocks // {PLACES})::bigint end) block
      from copies, (select greatest(1, round(sum(quota) / {mix.block_tokens}))::bigint n_blocks from quotas))
  select doc_id, source, n_tokens::bigint n_tokens, weight, epoch::bigint epoch, block::bigint block,
    row_number() over (partition by block order by md5('block{mix.seed}|' || block || '|' || epoch || '|' || place),
      doc_id, source, n_tokens, epoch) - 1 slot
  from blocked
"""


ORACLE = _oracle(Mix())
