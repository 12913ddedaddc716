"""O2, O7, O8: the views, as DataFrame functions registered as temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockroom.functions.money import as_double, line_amount
from stockroom.operators.products import product_list

CUSTOMER_ORDER_COLUMNS = ["c_custkey", "c_name", "c_mktsegment",
                          "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"]

ORDER_LINE_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "l_linenumber", "l_partkey",
                      "p_name", "p_brand", "l_quantity", "l_extendedprice", "l_discount", "amount"]


def customer_orders(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Each customer with each of their orders; a customer without orders
    gives one row with null order columns (a left join).

    Written as inner join UNION ALL anti join instead of one left outer
    join: a customer with a third of all orders makes the orders side of
    its partition huge, and AQE can split a skewed partition of the inner
    join on both sides but never the null-extended side of an outer join.
    The anti join needs only distinct order keys, which a partial aggregate
    reduces before the shuffle.
    """
    cols = ["c_custkey", "c_name", "c_mktsegment"]
    c = customer.filter(F.col("c_custkey").isNotNull()).select(*cols)
    o = orders.select(F.col("o_custkey").alias("c_custkey"),
                      "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    matched = c.join(o, "c_custkey", "inner")
    buyers = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
    # Both branches shuffle the same keyed customers, so the exchange is
    # reused; customers without a key cannot match and need no shuffle.
    lonely = c.join(buyers, "c_custkey", "left_anti").unionByName(
        customer.filter(F.col("c_custkey").isNull()).select(*cols))
    no_order = [F.lit(None).cast("bigint").alias("o_orderkey"),
                F.lit(None).cast("string").alias("o_orderstatus"),
                F.lit(None).cast("double").alias("o_totalprice"),
                F.lit(None).cast("timestamp_ntz").alias("o_orderdate")]
    return (matched.select(*CUSTOMER_ORDER_COLUMNS)
                   .unionByName(lonely.select(*cols, *no_order)))


def order_lines(orders: DataFrame, lineitem: DataFrame, part: DataFrame, salt: str | None = None) -> DataFrame:
    """Order x line x product with the discounted amount (computed exactly
    in decimal, presented as a double like the source prices; null if the
    price or the discount fits no decimal).  ``salt`` is the column that a salted
    layout (``sources.layout``) has besides the key.

    Two inner equi-joins; Spark picks broadcast or sort-merge from sizes
    (AQE re-decides at runtime and splits a hot order or product key).
    Lines are not deduplicated: (l_orderkey, l_linenumber) is not a key.
    """
    also = [salt] if salt else []
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", *also)
    li = lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey",
                         "l_quantity", "l_extendedprice", "l_discount", *also)
    p = part.select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand")
    return (li.join(o, ["o_orderkey", *also], "inner")
              .join(p, "l_partkey", "inner")
              .withColumn("amount", as_double(line_amount()))
              .select(*ORDER_LINE_COLUMNS))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Register the views over the loaded tables (temp views over temp views)."""
    from stockroom.operators.totals import order_totals, present_totals
    product_list(tables["part"]).createOrReplaceTempView("product_list")
    present_totals(order_totals(tables["orders"])).createOrReplaceTempView("order_totals")
    customer_orders(tables["customer"], tables["orders"]).createOrReplaceTempView("customer_orders")
    order_lines(tables["orders"], tables["lineitem"], tables["part"]).createOrReplaceTempView("order_lines")
