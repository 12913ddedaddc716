"""O9: stored procedures.

Spark has no CREATE PROCEDURE / CALL on plain tables, so a procedure is a
Python function of the tables and its parameters that returns a DataFrame;
the tables are the session's registered ones (``stockroom.sources.load``)
unless the caller gives others.  ``call``
looks the name up and checks the parameters before anything runs.

Read procedures are also registered as SQL table functions, so SQL users
can call them directly or per row with ``LATERAL``; Catalyst inlines and
decorrelates the body into a join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stockroom.operators import admission, products
from stockroom.operators.orders import get_orders
from stockroom.plans import storing, views


Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Procedure:
    """``body`` takes a function that opens a table by name, then the parameters."""
    body: Callable[..., DataFrame]
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    doc: str = ""


PROCEDURES: dict[str, Procedure] = {
    "get_orders": Procedure(
        lambda t, custkey, date_from=None, date_to=None: get_orders(t("orders"), custkey, date_from, date_to),
        required=("custkey",), optional=("date_from", "date_to"),
        doc="orders of one customer, date_from <= o_orderdate < date_to"),
    "product_list": Procedure(
        lambda t: products.product_list(t("part")),
        doc="all products"),
    "product_page": Procedure(
        lambda t, size=50, after=None: products.product_page(t("part"), size, after),
        optional=("size", "after"),
        doc="first products by (p_name, p_partkey), after a given one"),
    "add_customers": Procedure(
        lambda t, batch, seq="seq": admission.add_customers(t("customer"), batch, t("nation"), seq),
        required=("batch",), optional=("seq",),
        doc="a verdict for each incoming customer"),
    "accept_orders": Procedure(
        lambda t, batch, seq="seq": admission.accept_orders(t("orders"), batch, t("customer"), seq),
        required=("batch",), optional=("seq",),
        doc="a verdict for each incoming order"),
    "upsert_products": Procedure(
        lambda t, batch, seq=None: products.upsert_products(t("part"), batch, seq),
        required=("batch",), optional=("seq",),
        doc="merge a product batch into the product list"),
    "keep_products": Procedure(
        lambda t, batch, out_path, seq=None, request=None: storing.keep_products(
            t("part"), batch, out_path, seq, request),
        required=("batch", "out_path"), optional=("seq", "request"),
        doc="merge a product batch into the list stored at out_path, all or nothing"),
    "keep_customers": Procedure(
        lambda t, batch, out_path, seq="seq", request=None: storing.keep_customers(
            t("customer"), batch, t("nation"), out_path, seq, request),
        required=("batch", "out_path"), optional=("seq", "request"),
        doc="add customers to the table stored at out_path, all or nothing"),
    "keep_orders": Procedure(
        lambda t, batch, out_path, seq="seq", request=None: storing.keep_orders(
            t("orders"), batch, t("customer"), out_path, seq, request),
        required=("batch", "out_path"), optional=("seq", "request"),
        doc="accept orders into the table stored at out_path, all or nothing"),
    "customer_orders": Procedure(
        lambda t: views.customer_orders(t("customer"), t("orders")),
        doc="customers with their orders"),
    "order_lines": Procedure(
        lambda t: views.order_lines(t("orders"), t("lineitem"), t("part")),
        doc="order x line x product with amount"),
}


class ProcedureError(ValueError):
    pass


def call(spark: SparkSession, name: str, /, tables: Tables | None = None, **params) -> DataFrame:
    """Run procedure ``name``; unknown names and missing or unknown
    parameters raise ``ProcedureError`` before any Spark work.  Tables are the
    session's registered ones, or come from ``tables``, a function of their
    name."""
    proc = PROCEDURES.get(name)
    if proc is None:
        raise ProcedureError(f"unknown procedure {name!r}; known: {sorted(PROCEDURES)}")
    missing = [p for p in proc.required if p not in params]
    if missing:
        raise ProcedureError(f"{name}: missing parameter(s) {missing}")
    unknown = [p for p in params if p not in proc.required + proc.optional]
    if unknown:
        raise ProcedureError(f"{name}: unknown parameter(s) {unknown}")
    return proc.body(tables or spark.table, **params)


# SQL table functions over the registered views.  Bounds left NULL are open.
# ``{p}`` is the prefix of the functions and of the views they read.
SQL_FUNCTIONS = {
    "get_orders": """
CREATE OR REPLACE TEMPORARY FUNCTION {p}get_orders(
    k BIGINT, d_from DATE DEFAULT NULL, d_to DATE DEFAULT NULL)
RETURNS TABLE (o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,
               o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING)
RETURN SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
       FROM {p}orders
       WHERE o_custkey = k
         AND (d_from IS NULL OR o_orderdate >= d_from)
         AND (d_to IS NULL OR o_orderdate < d_to)
""",
    "order_lines_of": """
CREATE OR REPLACE TEMPORARY FUNCTION {p}order_lines_of(k BIGINT)
RETURNS TABLE (l_linenumber INT, l_partkey BIGINT, l_quantity DOUBLE,
               l_extendedprice DOUBLE, l_discount DOUBLE)
RETURN SELECT l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount
       FROM {p}lineitem WHERE l_orderkey = k
""",
    "customer_orders_of": """
CREATE OR REPLACE TEMPORARY FUNCTION {p}customer_orders_of(k BIGINT)
RETURNS TABLE (c_custkey BIGINT, c_name STRING, c_mktsegment STRING, o_orderkey BIGINT,
               o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ)
RETURN SELECT c.c_custkey, c.c_name, c.c_mktsegment, o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate
       FROM {p}customer c LEFT JOIN {p}orders o ON o.o_custkey = c.c_custkey
       WHERE c.c_custkey = k
""",
    # a page of at most n products behind (name, key); SQL functions take no
    # parameter in LIMIT, so the page is cut by rank, which Spark plans as a
    # top-k below the window
    "product_page": """
CREATE OR REPLACE TEMPORARY FUNCTION {p}product_page(
    n INT DEFAULT 50, name STRING DEFAULT NULL, k BIGINT DEFAULT NULL)
RETURNS TABLE (p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE)
RETURN SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
       FROM (SELECT *, row_number() OVER (ORDER BY p_name NULLS LAST, p_partkey NULLS LAST) AS place
             FROM {p}part
             WHERE k IS NULL OR p_name > name OR (p_name = name AND p_partkey > k)
                OR (name IS NULL AND p_name IS NULL AND p_partkey > k) OR (name IS NOT NULL AND p_name IS NULL))
       WHERE place <= n
""",
}


def register_sql_functions(spark: SparkSession, prefix: str = "") -> None:
    """Register the SQL table functions (needs the table views first, with
    the same ``prefix``)."""
    for ddl in SQL_FUNCTIONS.values():
        spark.sql(ddl.format(p=prefix))
