"""Retention by whole chunk."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidevault.functions.times import Instant, Width, ago, now
from tidevault.operators.chunks import ChunkedTable
from tidevault.operators.rollup import applied_of


def preview(table: ChunkedTable, older_than: Instant) -> DataFrame:
    """What :func:`drop_chunks` would remove; nothing is deleted."""
    return table.show_chunks(older_than=older_than)


def drop_chunks(table: ChunkedTable, older_than: Instant) -> list[int]:
    """Drop the chunks that end before the cut-off, whole, without reading a row.

    Notes of changes that no rollup needs any more go with them.
    """
    table.recover()
    ids = table.older_than(older_than)
    table.drop(ids)
    table.prune_changes(lambda root: applied_of(table.spark, root))
    return ids


def retain(
    table: ChunkedTable,
    as_of: Instant | None = None,
    drop_after: str | dt.timedelta | Width = "5 days",
) -> list[int]:
    """The retention policy; running it again at the same ``as_of`` drops nothing more."""
    return drop_chunks(table, ago(as_of or now(), drop_after))
