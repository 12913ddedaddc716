"""O2, O5, O7, O8 on hand-made rows and against brute force."""

import datetime as dt
from decimal import Decimal

from stockroom.functions.money import line_amount
from stockroom.operators.orders import get_orders
from stockroom.operators.products import product_page
from stockroom.plans.views import customer_orders, order_lines
from stockroom.schemas import CUSTOMER, LINEITEM, ORDERS, PART


def test_customer_without_orders_gets_one_null_row(spark):
    c = spark.createDataFrame([(1, "has", 0, 0.0, "S"), (2, "none", 0, 0.0, "S")], CUSTOMER)
    o = spark.createDataFrame([
        (10, 1, "O", 5.0, dt.datetime(1996, 1, 1), "1"),
        (11, 1, "O", 6.0, dt.datetime(1996, 2, 1), "1"),
    ], ORDERS)
    rows = sorted((r["c_custkey"], r["o_orderkey"]) for r in customer_orders(c, o).collect())
    assert rows == [(1, 10), (1, 11), (2, None)]


def test_order_lines_amount_is_exact(spark):
    o = spark.createDataFrame([(1, 7, "O", 0.0, dt.datetime(1996, 1, 1), "1")], ORDERS)
    li = spark.createDataFrame([
        (1, 3, 1, 1, 2.0, 0.1 + 0.2, 0.07, 0.0, "N", "O", dt.datetime(1996, 1, 5)),
        (1, 3, 1, 1, 1.0, 1000.05, 0.10, 0.0, "N", "O", dt.datetime(1996, 1, 5)),  # repeat line no.
    ], LINEITEM)
    p = spark.createDataFrame([(3, "bolt", "B", "T", 1, 1.0)], PART)
    got = sorted(r["amount"] for r in order_lines(o, li, p).collect())
    assert got == [0.279, 900.045]
    exact = sorted(r["a"] for r in li.select(line_amount().alias("a")).collect())
    assert exact == [Decimal("0.2790"), Decimal("900.0450")]


def test_get_orders_bounds(spark):
    o = spark.createDataFrame([
        (1, 7, "O", 1.0, dt.datetime(1995, 12, 31, 23, 59), "1"),
        (2, 7, "O", 1.0, dt.datetime(1996, 1, 1), "1"),
        (3, 7, "O", 1.0, dt.datetime(1997, 12, 31, 12), "1"),
        (4, 7, "O", 1.0, dt.datetime(1998, 1, 1), "1"),
        (5, 8, "O", 1.0, dt.datetime(1996, 6, 1), "1"),
    ], ORDERS)
    keys = lambda df: sorted(r["o_orderkey"] for r in df.collect())
    assert keys(get_orders(o, 7, "1996-01-01", "1998-01-01")) == [2, 3]
    assert keys(get_orders(o, 7)) == [1, 2, 3, 4]
    assert keys(get_orders(o, 7, date_from=dt.date(1997, 1, 1))) == [3, 4]


def test_product_pages_walk_the_whole_list(spark, tables001):
    part = tables001["part"]
    want = sorted(((r["p_name"], r["p_partkey"]) for r in part.collect()))
    seen, after = [], None
    while True:
        page = [(r["p_name"], r["p_partkey"]) for r in product_page(part, 37, after).collect()]
        if not page:
            break
        seen.extend(page)
        after = page[-1]
    assert seen == want


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=8),
       st.lists(st.one_of(st.none(), st.integers(0, 7)), max_size=15))
def test_customer_orders_is_a_left_join(spark, cust_keys, order_custs):
    c = spark.createDataFrame([(k, f"c{i}", 0, 0.0, "S") for i, k in enumerate(cust_keys)], CUSTOMER)
    o = spark.createDataFrame([(i, k, "O", 1.0, dt.datetime(1996, 1, 1), "1")
                               for i, k in enumerate(order_custs)], ORDERS)
    got = sorted(((r["c_name"], r["o_orderkey"]) for r in customer_orders(c, o).collect()),
                 key=repr)
    want = []
    for i, k in enumerate(cust_keys):
        hits = [j for j, ok in enumerate(order_custs) if k is not None and ok == k]
        want += [(f"c{i}", j) for j in hits] or [(f"c{i}", None)]
    assert got == sorted(want, key=repr)


def test_product_pages_include_null_names(spark):
    from stockroom.schemas import PART as P
    part = spark.createDataFrame([(i, None if i % 4 == 0 else f"n{i % 3}", "B", "T", 1, 1.0)
                                  for i in range(23)], P)
    seen, after = [], None
    while True:
        page = [(r["p_name"], r["p_partkey"]) for r in product_page(part, 5, after).collect()]
        if not page:
            break
        seen.extend(page)
        after = page[-1]
    want = sorted(((r["p_name"], r["p_partkey"]) for r in part.collect()),
                  key=lambda t: (t[0] is None, t[0] or "", t[1]))
    assert seen == want
