"""Prices that fit no total: refused in batch and stream, summed or counted where they stand."""

from datetime import datetime

import pytest

from stockroom.functions.money import line_amount
from stockroom.operators.admission import accept_orders
from stockroom.operators.totals import order_totals, order_totals_partial, present_totals
from stockroom.schemas import ORDERS
from stockroom.session import scratch_dir
from stockroom.streaming import ORDER_RULES, InsertTrigger, audit_log


def _orders(spark, prices):
    return spark.createDataFrame([(i, 1, "O", p, datetime(1996, 1, 1), "1-URGENT") for i, p in enumerate(prices)], ORDERS)


PRICES = [10.0, 9_999_999_999.99, 1e10, 1e11, -1e11, float("nan"), float("inf"), None, 1e30, 0.0]
VERDICTS = ["accepted", "accepted"] + ["bad_value"] * 5 + ["accepted", "bad_value", "accepted"]


def test_batch_and_stream_refuse_the_same_prices(spark, tables001):
    from pyspark.sql import functions as F
    customer = tables001["customer"]
    orders = _orders(spark, PRICES)
    got = accept_orders(orders.limit(0), orders.withColumn("seq", F.col("o_orderkey")), customer)
    assert [r["verdict"] for r in got.orderBy("o_orderkey").collect()] == VERDICTS
    work = scratch_dir(spark, "test-money")
    orders.coalesce(1).write.parquet(f"{work}/in/0")
    InsertTrigger(spark, f"{work}/in", f"{work}/out", ORDER_RULES, reference=customer).run_available()
    assert [r["verdict"] for r in audit_log(spark, f"{work}/out").orderBy("key").collect()] == VERDICTS


@pytest.mark.parametrize("halves", [False, True])
def test_totals_return_whatever_the_table_holds(spark, halves):
    orders = _orders(spark, PRICES)
    parts = [orders.filter("o_orderkey < 4"), orders.filter("o_orderkey >= 4")] if halves else [orders]
    r = order_totals(*parts).first()
    assert (r["n_orders"], r["n_unfit"], str(r["total_price"])) == (10, 3, "20000000009.99")
    assert present_totals(order_totals(*parts)).first()["total_price"] == 20000000009.99


def test_partials_without_the_count_still_merge(spark):
    from pyspark.sql import functions as F
    old = order_totals_partial(_orders(spark, [1.0])).withColumn("n_unfit", F.lit(None).cast("long"))
    from stockroom.operators.totals import merge_totals
    assert merge_totals(old).first()["n_unfit"] == 0
    assert merge_totals(old, order_totals_partial(_orders(spark, [1e30]))).first()["n_unfit"] == 1


def test_line_amounts(spark):
    df = spark.createDataFrame([(1e11, 0.25), (1e30, 0.1), (100.0, 20.0), (None, 0.1), (float("nan"), 0.0)],
                               "l_extendedprice double, l_discount double")
    got = [r["a"] for r in df.select(line_amount().alias("a")).collect()]
    assert float(got[0]) == 7.5e10 and got[1:] == [None] * 4
