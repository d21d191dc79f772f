"""Small-file compaction of recent day partitions.

Streaming appends leave many small files per day.  ``compact_recent`` packs the
small files of the days from ``as_of - days`` to ``as_of`` into files of about
``target_bytes``; which files are small, and how many new ones there are, comes
from the folder listing, never from reading rows.  Files that are large stay as
they are, so a second run rewrites nothing.

Inside the new files rows follow a space-filling curve over time and device,
in row groups of ``group_bytes``: the minima and maxima of a row group then
bound both columns, and a panel of some devices skips the groups of the others
(a table sorted by time has every device in every group).  The rows are
range-partitioned on (day, place on the curve), so one large day spreads over
many tasks.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from tidewater.functions.curve import interleave, scaled
from tidewater.session import SPLIT_BYTES
from tidewater.sources.tables import SORT_ORDER, TableStore, day_column


def recent_days(as_of: dt.date, days: int) -> list[str]:
    """Days ``as_of - days`` ... ``as_of`` inclusive, ISO text."""
    return [(as_of - dt.timedelta(days=i)).isoformat() for i in range(days, -1, -1)]


def small_files(store: TableStore, name: str, days: list[str], target_bytes: int) -> dict[str, list[tuple[str, int]]]:
    """Of each day the files under three quarters of the target, where there are at least two."""
    small = {d: [f for f in store.day_files(name, d) if f[1] < 0.75 * target_bytes] for d in days}
    return {d: files for d, files in small.items() if len(files) > 1}


def compact_recent(store: TableStore, name: str, as_of: dt.date | None = None, days: int = 2,
                   target_bytes: int = SPLIT_BYTES, group_bytes: int = SPLIT_BYTES // 8) -> int:
    """Pack the small files of the recent day partitions of ``name``; returns
    the number of output partitions planned (0 when there is nothing to pack)."""
    col = day_column(name)
    if col is None:
        raise ValueError(f"{name} is not day-partitioned")
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date()
    store.recover(name)
    chosen = small_files(store, name, recent_days(as_of, days), target_bytes)
    if not chosen:
        return 0
    n_out = sum(math.ceil(sum(size for _, size in files) / target_bytes) for files in chosen.values())
    paths = [path for files in chosen.values() for path, _ in files]
    rows = store.read_files(name, paths)
    time, key = SORT_ORDER[name]
    low, high = rows.agg(F.min(key), F.max(key)).first()
    seconds = F.unix_timestamp(time) - F.unix_timestamp(F.date_trunc("day", time))
    place = interleave(scaled(seconds, 0, 86400), scaled(F.col(key), low or 0, high or 0))
    order = [col, "_place", time, key]
    packed = rows.withColumn("_place", place).repartitionByRange(n_out, *order).sortWithinPartitions(*order).drop("_place")
    store.replace_files(name, paths, packed, **{"parquet.block.size": str(group_bytes)})
    return n_out
