"""O5: get orders of one customer in a date range."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _bound(v):
    """A date, datetime or ISO text as a TIMESTAMP_NTZ literal, so that the
    driver's time zone plays no part; a zoned value is refused."""
    if not isinstance(v, (dt.date, dt.datetime)):
        v = dt.datetime.fromisoformat(str(v))
    if not isinstance(v, dt.datetime):
        v = dt.datetime(v.year, v.month, v.day)
    if v.tzinfo is not None:
        raise ValueError(f"{v.isoformat()}: order dates have no time zone; give a bound without one")
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def get_orders(orders: DataFrame, custkey: int, date_from=None, date_to=None) -> DataFrame:
    """Orders of ``custkey`` with ``date_from <= o_orderdate < date_to``.

    An omitted bound is open.  The predicate is built only from the given
    bounds so that every part of it reaches the parquet scan as a pushed
    filter (one stage, no shuffle).
    """
    cond = F.col("o_custkey") == F.lit(int(custkey))
    if date_from is not None:
        cond = cond & (F.col("o_orderdate") >= _bound(date_from))
    if date_to is not None:
        cond = cond & (F.col("o_orderdate") < _bound(date_to))
    return orders.filter(cond)
