"""Bucketed orders and lineitem: order_lines joins them without a shuffle."""

import contextlib
import io
import uuid

from stockroom.plans.views import order_lines
from stockroom.schemas import ORDERS
from stockroom.session import scratch_dir
from stockroom.sources.layout import open_bucketed, write_bucketed


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_bucketed_join_skips_the_shuffle(spark, tables001):
    work = scratch_dir(spark, "bucketed")
    tag = uuid.uuid4().hex[:8]
    o = write_bucketed(tables001["orders"], f"orders_b_{tag}", f"{work}/orders", "o_orderkey", 8)
    li = write_bucketed(tables001["lineitem"], f"lineitem_b_{tag}", f"{work}/lineitem",
                        "l_orderkey", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = order_lines(tables001["orders"], tables001["lineitem"], tables001["part"])
        bucketed = order_lines(o, li, tables001["part"])
        # plain: lineitem, orders, joined rows and part are shuffled; bucketed: the last two only
        assert _plan(plain).count("Exchange hashpartitioning") == 4
        assert _plan(bucketed).count("Exchange hashpartitioning") == 2
        assert sorted(map(tuple, bucketed.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)

    # a later session registers the same directory again
    again = open_bucketed(spark, f"orders_b2_{tag}", f"{work}/orders", ORDERS, "o_orderkey", 8)
    assert again.count() == tables001["orders"].count()


def test_hot_order_is_split_over_files(spark, tables001):
    """An order with a third of all lines: no file of the salted layout is
    much above a piece, and the join gives the same rows."""
    from pyspark.sql import functions as F

    from stockroom import files
    from stockroom.sources.layout import SALT, write_salted
    n, piece, buckets = 60_000, 1000, 16
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None).cast("long")).otherwise(F.col("id") % 997 + 100)
    rows = spark.range(n).select(key.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(5).cast("long").alias("l_partkey"),
                                 F.lit(1.0).alias("l_quantity"), F.lit(2.5).alias("l_extendedprice"), F.lit(0.1).alias("l_discount"))
    orders = spark.range(1200).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"),
                                      F.lit("1996-01-01").cast("timestamp_ntz").alias("o_orderdate"))
    part = tables001["part"].withColumn("p_partkey", F.lit(5).cast("long")).limit(1)
    tag, work = uuid.uuid4().hex[:8], scratch_dir(spark, "salted")
    lines, heads = write_salted(rows, "l_orderkey", orders, "o_orderkey", (f"sl_{tag}", f"so_{tag}"), work, buckets, piece)
    pieces = {r["n"]: r["k"] for r in lines.filter("l_orderkey = 7").groupBy(SALT).count()
              .groupBy(F.col("count").alias("n")).agg(F.count("*").alias("k")).collect()}
    assert sum(n_ * k for n_, k in pieces.items()) == n // 3 and len(pieces) <= 20 and max(pieces) <= 1.5 * piece
    per_file = [r["count"] for r in lines.groupBy(F.input_file_name()).count().collect()]
    assert max(per_file) <= 3 * n / buckets and len(per_file) > buckets // 2
    assert heads.filter(F.col(SALT) == 0).count() == 1200 and heads.count() > 1200
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = order_lines(heads, lines, part, salt=SALT)
        assert _plan(lines.join(heads, (F.col("l_orderkey") == F.col("o_orderkey")) & (lines[SALT] == heads[SALT]))).count("Exchange") == 0
        assert joined.count() == order_lines(orders, rows, part).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert files.sizes(spark, f"{work}/sl_{tag}")
