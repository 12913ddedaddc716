"""Plan shape: pushdown, pruning, top-k, and no shuffle of big sides for
small batches."""

import contextlib
import io

from stockroom.plans.queries import QUERIES
from tests.conftest import SF01


def _formatted(spark, df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_get_orders_filter_reaches_scan(spark):
    text = _formatted(spark, QUERIES["get_orders"](spark, SF01))
    assert "EqualTo(o_custkey,7)" in text
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "Exchange" not in text


def test_product_page_is_top_k(spark):
    assert "TakeOrderedAndProject" in _formatted(spark, QUERIES["product_page"](spark, SF01))


def test_order_lines_reads_only_needed_columns(spark):
    text = _formatted(spark, QUERIES["order_lines"](spark, SF01))
    assert "l_shipdate" not in text and "l_returnflag" not in text and "o_totalprice" not in text


def test_small_batch_probes_existing_without_shuffling_it(spark):
    text = _formatted(spark, QUERIES["accept_orders"](spark, SF01))
    assert "SortMergeJoin" not in text
    assert "BroadcastHashJoin LeftSemi" in text


def test_views_compose_with_pushdown(spark):
    from stockroom.plans.views import register_views
    from stockroom.sources import load
    register_views(spark, load(spark, SF01, register=True))
    assert spark.table("order_lines").count() == 60000
    assert spark.sql("SELECT sum(n_orders) AS n FROM order_totals").first()["n"] == 15000
    df = spark.table("customer_orders").filter("c_custkey = 7")
    text = _formatted(spark, df)
    assert "EqualTo(c_custkey,7)" in text and "EqualTo(o_custkey,7)" in text
    assert df.count() == spark.table("orders").filter("o_custkey = 7").count()


def test_hot_customer_join_is_split_by_aqe(spark):
    """One customer holds a third of all orders: AQE splits that partition
    of the inner join (the reason customer_orders avoids an outer join)."""
    from pyspark.sql import functions as F

    from stockroom.plans.views import customer_orders
    n = 300_000
    orders = spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        F.lit(None).cast("timestamp_ntz").alias("o_orderdate"))
    customer = spark.range(5000).select(F.col("id").alias("c_custkey"),
                                        F.lit("c").alias("c_name"), F.lit("S").alias("c_mktsegment"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = customer_orders(customer, orders)
        assert len(df.collect()) == n
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()          # after execution: the final adaptive plan
        text = buf.getvalue()
        assert "isFinalPlan=true" in text
        assert "isSkewJoin=true" in text or "skew=true" in text, text
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_hot_reference_in_a_big_batch_is_split_by_aqe(spark):
    """Shuffled admission plan (probe limit 0): one customer is the reference
    of a third of the incoming orders; AQE splits that partition of the
    reference join, and the verdicts stay exact."""
    from pyspark.sql import functions as F

    from stockroom.operators.admission import accept_orders
    n = 300_000
    batch = spark.range(n).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        F.lit(None).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1").alias("o_orderpriority"), F.col("id").alias("seq"))
    customer = spark.range(4000).select(F.col("id").alias("c_custkey"))
    existing = spark.range(0).select(F.col("id").alias("o_orderkey"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.shuffle.partitions": "16",
            "spark.stockroom.probe.maxRows": "0"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        v = accept_orders(existing, batch, customer)
        rows = v.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            v.explain()
        text = buf.getvalue()
    finally:
        for k, val in old.items():
            if val is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, val)
    assert len(rows) == n
    unknown = sum(1 for r in rows if r["verdict"] == "unknown_customer")
    assert unknown == sum(1 for r in rows if r["o_custkey"] >= 4000)
    assert "isFinalPlan=true" in text
    assert "isSkewJoin=true" in text or "skew=true" in text, text


def test_batch_is_read_once_from_its_source(spark):
    """What follows the first read of a batch reads what was written of it:
    the batch twice (keyed rows, null keys), the first rows three times."""
    from stockroom.operators.admission import accept_orders
    from stockroom.sources import batches
    from stockroom.sources.tables import read_table
    o = read_table(spark, SF01, "orders")
    batch = batches.order_batch(o)
    v = accept_orders(o.filter("o_orderkey < 0"), batch, read_table(spark, SF01, "customer"))
    scans = [ln for ln in _formatted(spark, v).splitlines() if ln.startswith("Location:")]
    assert sum("/batch-" in s for s in scans) == 2 and sum("/first-rows-" in s for s in scans) == 3
    assert sum("orders.parquet" in s for s in scans) == 1          # the existing table
