"""Settings of a run. Every model function takes them explicitly."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # First day loaded by a full build, late-arrival window,
    # first day and length of the calendar, reporting currency of the raw data.
    start_date: dt.datetime = dt.datetime(2016, 1, 1)
    lookback_days: int = 3
    calendar_start: dt.date = dt.date(2016, 1, 1)
    calendar_days: int = 1826
    default_currency: str = "BRL"

    # Physical layout of the order fact: "month" or "day". Use "day" once one
    # month of items is more than an incremental run should rewrite.
    fact_partition: str = "month"

    # A load of at most this many orders is shuffled to its periods, so that each lies in few files. Of a larger
    # one each task that brings items to their orders writes a file per month, of about a megabyte or more, so that
    # its rows are shuffled once less. Days are always gathered.
    gather_max_orders: int = 2_000_000

    # Whether the purchase time of an order never changes. If so, an incremental
    # run looks for the rows it replaces in recent partitions only, instead of
    # reading the key column of the whole fact.
    fixed_order_times: bool = False

    # What an incremental run does with a target that exists but is empty:
    # "none" loads nothing (the watermark is NULL), "full" rebuilds.
    empty_target: str = "none"

    # A lookup with at most this many rows is broadcast; a larger one is shuffled.
    # The second limit is for frames of bare ids, which filter other tables.
    broadcast_max_rows: int = 100_000
    broadcast_max_ids: int = 1_000_000
    # Neither is broadcast if its rows, at the usual size of its columns, take more than this.
    broadcast_max_bytes: int = 64_000_000

    # Most bits of the filter that stands for the keys of a larger upsert batch. It takes a quarter of
    # that in bytes when broadcast, and serves for up to two thirds as many keys.
    upsert_filter_bits: int = 2**27

    # A join key is hot when it holds at least this many rows and this share of
    # all rows. It is split into salts of about a quarter of `hot_key_min_rows`.
    hot_key_min_rows: int = 1_000_000
    hot_key_share: float = 0.001
