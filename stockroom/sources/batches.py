"""Incoming batches derived from the given tables (FIXTURES.md §2).

No batches are supplied with the data, so each scenario splits a table
into an "existing" part and an "incoming" batch.  Every row of the table
lands on one side or both: the splits define the scenario, they do not
shrink the work.  The DuckDB oracle builds the same batches in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockroom.schemas import CUSTOMER, ORDERS, PART

_CUST = [f.name for f in CUSTOMER.fields]
_ORD = [f.name for f in ORDERS.fields]
_PART = [f.name for f in PART.fields]


def existing_customers(customer: DataFrame) -> DataFrame:
    return customer.filter(F.col("c_custkey") % 10 != 0)


def customer_batch_parts(customer: DataFrame) -> list[DataFrame]:
    """The five parts of the incoming customers, in arrival order, each
    with ``seq``: new, already present, repeated, unknown nation, null key."""
    k = F.col("c_custkey")

    def part(cond, seq_add, key=None, nation=None):
        cols = []
        for c in _CUST:
            if c == "c_custkey" and key is not None:
                cols.append(key.alias(c))
            elif c == "c_nationkey" and nation is not None:
                cols.append(nation.alias(c))
            else:
                cols.append(F.col(c))
        return customer.filter(cond).select(*cols, (k * 10 + seq_add).alias("seq"))

    return [part(k % 10 == 0, 0),
            part(k % 100 == 1, 1),
            part(k % 50 == 0, 2),
            part(k % 75 == 0, 3, key=k + 1000000, nation=F.lit(99).cast("int")),
            part(k % 50 == 3, 4, key=F.lit(None).cast("bigint"))]


def _one_pass(df: DataFrame, parts: list[tuple]) -> DataFrame:
    """Rows of several filtered copies of ``df`` in one scan: each row
    yields one struct per part whose condition holds (``inline`` of a
    filtered array), instead of a union that reads the table once per part."""
    any_part = parts[0][0]
    for cond, _ in parts[1:]:
        any_part = any_part | cond
    arr = F.array(*[F.when(cond, row) for cond, row in parts])
    return df.filter(any_part).select(F.inline(F.array_compact(arr)))


def customer_batch(customer: DataFrame) -> DataFrame:
    """All incoming customers with ``seq`` (the parts above, one scan)."""
    k = F.col("c_custkey")

    def row(seq_add, key=None, nation=None):
        return F.struct((k if key is None else key).alias("c_custkey"), F.col("c_name"),
                        (F.col("c_nationkey") if nation is None else nation).alias("c_nationkey"),
                        F.col("c_acctbal"), F.col("c_mktsegment"),
                        (k * 10 + seq_add).alias("seq"))

    return _one_pass(customer, [
        (k % 10 == 0, row(0)),
        (k % 100 == 1, row(1)),
        (k % 50 == 0, row(2)),
        (k % 75 == 0, row(3, key=k + 1000000, nation=F.lit(99).cast("int"))),
        (k % 50 == 3, row(4, key=F.lit(None).cast("bigint"))),
    ])


def existing_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderkey") % 10 != 0)


def order_batch(orders: DataFrame) -> DataFrame:
    """Incoming orders with ``seq = o_orderkey * 10``; every hundredth order
    points at a customer that does not exist."""
    k = F.col("o_orderkey")
    cust = F.when(k % 100 == 0, F.col("o_custkey") + 10000000).otherwise(F.col("o_custkey"))
    return (orders.filter((k % 10 == 0) | (k % 1000 == 7))
                  .select(*[cust.alias(c) if c == "o_custkey" else F.col(c) for c in _ORD],
                          (k * 10).alias("seq")))


def product_batch(part: DataFrame) -> DataFrame:
    """Incoming products: a fifth of the keys again (half of them with a new
    price) plus new keys; one scan of ``part``."""
    k = F.col("p_partkey")
    price = F.when(k % 10 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))

    def row(key, retail):
        return F.struct(key.alias("p_partkey"), *[F.col(c) for c in _PART[1:-1]],
                        retail.alias("p_retailprice"))

    return _one_pass(part, [
        (k % 10 < 2, row(k, price)),
        (k % 20 == 5, row(k + 1000000, F.col("p_retailprice"))),
    ])


def order_partials(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts of all orders, as if accepted by two batches."""
    k = F.col("o_orderkey")
    return orders.filter(k % 10 != 0), orders.filter(k % 10 == 0)
