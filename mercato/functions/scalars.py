"""Column helpers. Each one expands to built-ins, so Catalyst sees through it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-in for a NULL part and separator of a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 over the text form of `parts`.

    The text form matters: pass ids as strings or bigints, never as doubles.
    """
    texts = [F.coalesce(_column(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *texts))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL when the denominator is zero or NULL. Integers divide to double."""
    return F.try_divide(_column(numerator), _column(denominator))


def cents_to_currency(cents: Column | str, currency_code: str = "BRL") -> Column:
    """Currency units with two decimals from an amount in cents.

    Fractions of a cent are rounded away first. `currency_code` only documents
    the call; every currency here has 100 cents.
    """
    cent = F.lit("0.01").cast("decimal(2,2)")
    return (_column(cents).cast("decimal(38,0)") * cent).cast("decimal(38,2)")


def current_timestamp_utc() -> Column:
    """Wall-clock time in UTC without a zone, whatever zone the session uses."""
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
    )


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Number of midnights between `start` and `end`, negative if `end` is earlier."""
    return F.datediff(_column(end), _column(start))


MICROS = 1_000_000


def micros(amount: Column | str) -> Column:
    """A float amount in whole millionths of a unit.

    Sums of it do not depend on row order and are much cheaper than decimal ones. Digits
    beyond the sixth are rounded; from 9 * 10^9 on, a double has no more than six itself.
    """
    return F.rint(_column(amount) * float(MICROS)).cast("bigint")


def from_micros(total: Column, precision: int = 18) -> Column:
    """The amount of a sum of millionths, with six decimals. Up to 18 digits it takes 8 bytes."""
    micro = F.lit("0.000001").cast("decimal(6,6)")
    return (total.cast("decimal(20,0)") * micro).cast(f"decimal({precision},6)")


def sum_money(amount: Column | str) -> Column:
    """Sum of a float amount within a group, with six decimals; round it when it is shown.

    Whole units and millionths are summed apart, so a group may hold 9 * 10^18 units.
    """
    m = micros(amount)
    rest = F.pmod(m, F.lit(MICROS))
    units, rest = F.sum(F.call_function("div", m - rest, F.lit(MICROS))), F.sum(rest)
    return (units.cast("decimal(20,0)") + from_micros(rest, 26)).cast("decimal(28,6)")


def ntz(value: dt.datetime) -> Column:
    """Literal timestamp without a zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
