"""O9: the storing procedures, on stored tables (``sources.stored``).

Each gives every row of the batch its verdict against the stored table (or,
on the first call, against the given one), writes the rows once, apart by
verdict, and makes all of them count with one commit.  A call that fails may
be made again; with a ``request`` name it is applied once.  Scratch that the
verdicts were built on is removed after the call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockroom.operators import admission, products
from stockroom.schemas import CUSTOMER, ORDERS, PART
from stockroom.sources.stored import StoredTable


def keep_customers(customer: DataFrame, batch: DataFrame, nation: DataFrame, out_path: str,
                   seq: str = "seq", request: str | None = None) -> DataFrame:
    """Add customers to the table stored at ``out_path``, which begins as
    ``customer``.  Returns the table after the call."""
    table = StoredTable(customer.sparkSession, out_path, CUSTOMER)
    return table.change(lambda existing, scratch: admission.add_customers(existing, batch, nation, seq, scratch=scratch),
                        by=admission.VERDICT, accepted={admission.ACCEPTED}, request=request, base=customer)


def keep_orders(orders: DataFrame, batch: DataFrame, customer: DataFrame, out_path: str,
                seq: str = "seq", request: str | None = None) -> DataFrame:
    """Accept orders into the table stored at ``out_path``, which begins as
    ``orders``.  Returns the table after the call."""
    table = StoredTable(orders.sparkSession, out_path, ORDERS)
    return table.change(lambda existing, scratch: admission.accept_orders(existing, batch, customer, seq, scratch=scratch),
                        by=admission.VERDICT, accepted={admission.ACCEPTED}, request=request, base=orders)


def keep_products(part: DataFrame, batch: DataFrame, out_path: str, seq: str | None = None,
                  request: str | None = None) -> DataFrame:
    """Merge a product batch into the list stored at ``out_path``, which
    begins as ``part``.  The merged list is written whole (copy on write);
    rows without a key are refused.  Returns the list after the call."""
    table = StoredTable(part.sparkSession, out_path, PART)
    return table.change(lambda current, scratch: products.upsert_products(current, batch, seq, scratch=scratch), by="action",
                        accepted={products.INSERTED, products.UPDATED, products.UNCHANGED, products.KEPT},
                        request=request, base=part, replace=True)
