"""O12: kept order totals per customer, as partial aggregates that merge."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.functions.money import TOTAL, as_double, total, unfit

TOTAL_COLUMNS = ["o_custkey", "n_orders", "total_price", "last_order_date", "n_unfit"]


def order_totals_partial(accepted_orders: DataFrame) -> DataFrame:
    """Per customer: order count, exact price total, last order date, and
    how many prices no total can hold (they are in the count alone).

    A grouped aggregate with map-side partial combine: a customer that holds
    a third of the orders shrinks to one row per map task before the shuffle.
    """
    return (accepted_orders.groupBy("o_custkey")
            .agg(F.count(F.lit(1)).alias("n_orders"),
                 total("o_totalprice").alias("total_price"),
                 F.max("o_orderdate").alias("last_order_date"),
                 unfit("o_totalprice").alias("n_unfit")))


def merge_totals(*partials: DataFrame) -> DataFrame:
    """Re-aggregate partials (one per trigger batch) into current totals.
    Partials written before ``n_unfit`` was kept count as without any."""
    allp = reduce(DataFrame.unionByName, [p.select(*TOTAL_COLUMNS) for p in partials])
    return (allp.groupBy("o_custkey")
            .agg(F.sum("n_orders").alias("n_orders"),
                 F.sum("total_price").cast(TOTAL).alias("total_price"),
                 F.max("last_order_date").alias("last_order_date"),
                 F.coalesce(F.sum("n_unfit"), F.lit(0)).alias("n_unfit")))


def present_totals(totals: DataFrame) -> DataFrame:
    """Totals for readers: the exact decimal total as a double.  Partials
    and snapshots stay decimal so that merging them stays exact."""
    return totals.withColumn("total_price", as_double("total_price"))


def order_totals(*accepted_deltas: DataFrame) -> DataFrame:
    """O12 over batches of accepted orders: one partial per delta, then
    the merge (what the trigger does across micro-batches)."""
    return merge_totals(*[order_totals_partial(d) for d in accepted_deltas])
