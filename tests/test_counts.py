"""Expected counts of FIXTURES.md §3 at all three scales, catching a
mistake that the Spark side and the oracle could share."""

import pytest
from pyspark.sql import functions as F

from stockroom.plans.queries import QUERIES

SCALES = {
    "/root/testdata/sf0.001": 1,
    "/root/testdata/sf0.01": 10,
    "/root/testdata/sf0.1": 100,
}


def _n(spark, sf, name):
    return QUERIES[name](spark, sf).count()


def _by(spark, sf, name, col):
    rows = QUERIES[name](spark, sf).groupBy(col).count().collect()
    return {r[col]: r["count"] for r in rows}


@pytest.mark.parametrize("sf", list(SCALES))
def test_row_counts(spark, sf):
    m = SCALES[sf]
    assert _n(spark, sf, "product_list") == 200 * m
    assert _n(spark, sf, "product_page") == 50
    assert _n(spark, sf, "upsert_products") == 210 * m
    assert _n(spark, sf, "add_customers") == {1: 25, 10: 245, 100: 2450}[m]
    assert _n(spark, sf, "customers_after_add") == 150 * m
    assert _n(spark, sf, "get_orders") == {1: 4, 10: 2, 100: 3}[m]
    assert _n(spark, sf, "customer_orders") == {1: 1500, 10: 15000, 100: 150001}[m]
    assert _n(spark, sf, "order_lines") == 6000 * m
    assert _n(spark, sf, "order_totals") == {1: 150, 10: 1500, 100: 14999}[m]


@pytest.mark.parametrize("sf", list(SCALES))
def test_upsert_actions(spark, sf):
    m = SCALES[sf]
    assert _by(spark, sf, "upsert_products", "action") == {
        "inserted": 10 * m, "updated": 20 * m, "unchanged": 20 * m, "kept": 160 * m}


CUSTOMER_VERDICTS = {
    1: {"accepted": 15, "already_exists": 2, "duplicate_in_batch": 3, "unknown_nation": 2, "null_key": 3},
    10: {"accepted": 150, "already_exists": 15, "duplicate_in_batch": 30, "unknown_nation": 20,
         "null_key": 30},
    100: {"accepted": 1500, "already_exists": 150, "duplicate_in_batch": 300, "unknown_nation": 200,
          "null_key": 300},
}


@pytest.mark.parametrize("sf", list(SCALES))
def test_customer_verdicts(spark, sf):
    want = CUSTOMER_VERDICTS[SCALES[sf]]
    assert _by(spark, sf, "add_customers", "verdict") == want
    assert _n(spark, sf, "add_customers") == sum(want.values())


@pytest.mark.parametrize("sf", list(SCALES))
def test_order_verdicts(spark, sf):
    m = SCALES[sf]
    want = {1: (135, 2, 15), 10: (1350, 15, 150), 100: (13500, 150, 1500)}[m]
    assert _by(spark, sf, "accept_orders", "verdict") == dict(
        zip(["accepted", "already_exists", "unknown_customer"], want))


def test_customers_after_add_has_unique_keys(spark):
    df = QUERIES["customers_after_add"](spark, "/root/testdata/sf0.001")
    assert df.select("c_custkey").distinct().count() == df.count()
    assert df.filter(F.col("c_custkey").isNull()).count() == 0
