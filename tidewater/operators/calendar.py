"""Calendar dimension: distinct dates of a batch -> 11 attributes -> insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewater.functions.timefn import date_key, iso_day_of_week
from tidewater.operators.merge import insert_if_absent
from tidewater.schemas import DIM_DATE

WEEKEND_FROM = 6  # Saturday = 6, Sunday = 7 on the Monday = 1 scale


def calendar_rows(batch: DataFrame, time_col: str = "event_time") -> DataFrame:
    """One dim_date row per distinct calendar date in ``batch``.

    ``distinct`` on a date is a partial (map-side) aggregate, so the shuffle
    carries at most one row per date per task.
    """
    d = F.col("d")
    dow = iso_day_of_week(d)
    dates = batch.select(F.to_date(F.col(time_col)).alias("d")).where(d.isNotNull()).distinct()
    return dates.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (dow >= WEEKEND_FROM).alias("is_weekend"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in DIM_DATE.fields])


def upsert_dates(dim_date: DataFrame, batch: DataFrame, time_col: str = "event_time") -> DataFrame:
    """New dim_date state: existing rows plus dates not yet present."""
    return insert_if_absent(dim_date, calendar_rows(batch, time_col), ["date_key"])


def new_dates(dim_date: DataFrame, batch: DataFrame, time_col: str = "event_time") -> DataFrame:
    """Only the rows to append (what an append-only writer needs)."""
    rows = calendar_rows(batch, time_col)
    return rows.join(dim_date.select("date_key"), "date_key", "left_anti").select(*DIM_DATE.fieldNames())
