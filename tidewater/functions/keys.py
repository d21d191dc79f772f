"""Surrogate and row keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KEY_SEPARATOR = "||"


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the parts joined with ``||``; NULL parts are skipped."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[c.cast("string") for c in cols]))


def random_row_key() -> Column:
    """Random UUID per row (not reproducible across retries)."""
    return F.expr("uuid()")


def content_row_key(*parts: Column | str) -> Column:
    """Reproducible row key: the same natural key always gives the same id,
    so a retried or re-delivered batch cannot mint a second identity."""
    return surrogate_key(*parts)
