"""Data checks. A check is a query for failing rows; it passes when there are none."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.config import Settings
from mercato.functions import ntz
from mercato.operators.joins import Lookup, enrich

# ---- conditions under which a single row fails. NULL passes unless said otherwise.


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_not_accepted(column: str, values: Sequence) -> Column:
    return ~F.col(column).isin(list(values))


def is_in_future(column: str, now: dt.datetime | None = None) -> Column:
    return F.col(column) > (F.current_timestamp() if now is None else ntz(now))


def is_negative(column: str) -> Column:
    return F.col(column) < 0


def is_invalid_score(column: str) -> Column:
    """Outside 1 to 5, or NULL."""
    return ~F.col(column).between(1, 5) | F.col(column).isNull()


# ---- failing rows


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(is_missing(column))


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(is_not_accepted(column, values))


def no_future_dates(df: DataFrame, column: str, now: dt.datetime | None = None) -> DataFrame:
    return df.filter(is_in_future(column, now))


def positive_values(df: DataFrame, column: str) -> DataFrame:
    """Fails for negative values only: zero passes."""
    return df.filter(is_negative(column))


def valid_scores(df: DataFrame, column: str = "review_score") -> DataFrame:
    return df.filter(is_invalid_score(column))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("unique_field"))
        .agg(F.count("*").alias("n_records"))
        .filter("n_records > 1")
    )


def relationships(
    child: DataFrame, column: str, parent: DataFrame, field: str, settings: Settings
) -> DataFrame:
    """Child rows whose value is in no parent row."""
    known = parent.select(F.col(field).alias(column))
    return enrich(
        child.filter(F.col(column).isNotNull()),
        [Lookup(known, column, how="left_anti")],
        settings,
        size=child.count,
    )


def freshness(
    df: DataFrame, loaded_at: str, now: dt.datetime, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest row and its status: pass, warn or error. No rows at all is an error."""
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.col("as_of")) / F.lit(3600)
    return (
        df.agg(F.max(loaded_at).alias("max_loaded_at"))
        .withColumn("as_of", ntz(now))
        .withColumn("age_hours", age)
        .withColumn(
            "status",
            F.when(F.col("age_hours") <= warn_hours, "pass")
            .when(F.col("age_hours") <= error_hours, "warn")
            .otherwise("error"),
        )
    )


# ---- suites


@dataclass(frozen=True)
class Check:
    """A declared check of one column."""

    model: str
    column: str
    kind: str
    values: tuple = ()
    to: str = ""  # parent model of a relationship
    field: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def _row_condition(check: Check, now: dt.datetime | None) -> Column | None:
    if check.kind == "not_null":
        return is_missing(check.column)
    if check.kind == "accepted_values":
        return is_not_accepted(check.column, check.values)
    if check.kind == "no_future_dates":
        return is_in_future(check.column, now)
    if check.kind == "positive_values":
        return is_negative(check.column)
    if check.kind == "valid_scores":
        return is_invalid_score(check.column)
    return None


@dataclass(frozen=True)
class _Values:
    """The values of one column, and those of the columns that refer to it. `id` is the number of their first check.

    They are hashed as texts if `as_text`: hashes of equal values agree only if their types do.
    """

    id: int
    model: str
    column: str
    as_text: bool
    children: list[tuple[str, str]]

    def hashed(self, column: str) -> Column:
        return F.col(column).cast("string") if self.as_text else F.col(column)


def _values(checks: Sequence[tuple[int, Check]], models: Mapping[str, DataFrame]) -> dict[tuple, _Values]:
    """The columns whose values are counted, once each, for all unique checks and relationships that ask for them."""
    found: dict[tuple, _Values] = {}
    for number, c in checks:
        if c.kind == "relationships":
            child, parent = models[c.model].schema[c.column].dataType, models[c.to].schema[c.field].dataType
            at = (c.to, c.field, child != parent)
            found.setdefault(at, _Values(number, *at, [])).children.append((c.model, c.column))
        elif c.kind == "unique":
            at = (c.model, c.column, False)
            found.setdefault(at, _Values(number, *at, []))
    return found


def _finding(number: int, value: Column | None = None, side: int = 0) -> Column:
    """(id, h1, h2, side). 12 bytes stand for a value, whatever its length; side 0 is the column itself, others refer to it.

    Two values share them by chance no sooner than among some 10^14; among 10^9 the odds are one in 10^11.
    """
    hashes = (F.lit(None).cast("bigint"), F.lit(None).cast("int")) if value is None else (F.xxhash64(value), F.hash(value))
    return F.struct(F.lit(number).alias("id"), hashes[0].alias("h1"), hashes[1].alias("h2"), F.lit(side).alias("side"))


def _findings(
    name: str,
    model: DataFrame,
    values: Sequence[_Values],
    checks: Sequence[tuple[int, Check]],
    now: dt.datetime | None,
) -> DataFrame:
    """What the model `name` adds to the checks: a row per failed row condition, and a hashed value per value that must
    be unique or is on either side of a relationship."""
    found = []
    for number, c in checks:
        condition = _row_condition(c, now) if c.model == name else None
        if condition is not None:
            found.append(F.when(condition, _finding(number)))
    for v in values:
        for side, (at, column) in enumerate([(v.model, v.column), *v.children]):
            # A column that refers to itself adds nothing: no value can be missing.
            if at == name and (side == 0 or (at, column) != (v.model, v.column)):
                value = v.hashed(column)
                found.append(F.when(value.isNotNull(), _finding(v.id, value, side)))
    return model.select(F.inline(F.array_compact(F.array(*found))))


def run_checks(
    checks: Sequence[Check], models: Mapping[str, DataFrame], now: dt.datetime | None = None
) -> DataFrame:
    """One row per check: (check, model, column, failures, status).

    Each model is read once for all its conditions, unique columns and sides of relationships, and all of
    them are counted in one shuffle, map-side first. A column that must be unique and that others refer to adds each
    value once. There is no join: a value without parent is one that only the child's side has brought.
    """
    spark = next(iter(models.values())).sparkSession
    numbered = list(enumerate(checks))
    used = dict.fromkeys(m for c in checks for m in ((c.model, c.to) if c.kind == "relationships" else (c.model,)))
    values = _values(numbered, models)
    findings = [_findings(name, models[name], [*values.values()], numbered, now) for name in used]
    sides = range(1, 1 + max((len(v.children) for v in values.values()), default=0))
    per_value = (
        reduce(DataFrame.unionByName, findings)
        .groupBy("id", "h1", "h2")
        .agg(*[F.count_if(F.col("side") == i).alias(f"n{i}") for i in (0, *sides)])
    )
    # Of values, those that repeat or lack a parent fail, the latter with all their rows; of conditions, each row does.
    counts = per_value.groupBy("id").agg(
        F.sum("n0").alias("rows"),
        F.count_if(F.col("n0") > 1).alias("repeated"),
        *[F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}"))).alias(f"missing{i}") for i in sides],
    )
    declared, asked = [], {i: 0 for i in (v.id for v in values.values())}
    for number, c in numbered:
        at, figure = number, "rows"
        if c.kind == "unique":
            at, figure = values[c.model, c.column, False].id, "repeated"
        elif c.kind == "relationships":
            as_text = models[c.model].schema[c.column].dataType != models[c.to].schema[c.field].dataType
            at = values[c.to, c.field, as_text].id
            asked[at] += 1
            figure = f"missing{asked[at]}"
        declared.append((at, figure, c.name, c.model, c.column))
    named = spark.createDataFrame(declared, "id int, figure string, check string, model string, column string")
    failed = F.coalesce(*[F.when(F.col("figure") == f, F.col(f)) for f in counts.columns if f != "id"])
    failures = F.coalesce(failed, F.lit(0)).cast("bigint")
    return (
        named.join(F.broadcast(counts), "id", "left")
        .select(
            "check",
            "model",
            "column",
            failures.alias("failures"),
            F.when(failures == 0, "pass").otherwise("fail").alias("status"),
        )
    )
