"""O9: the procedure registry and the SQL table functions."""

import pytest

from stockroom.operators.orders import get_orders
from stockroom.plans.procedures import PROCEDURES, ProcedureError, call, register_sql_functions
from stockroom.session import scratch_dir
from stockroom.sources import load
from stockroom.sources.batches import customer_batch
from tests.conftest import SF001


@pytest.fixture(scope="module")
def db(spark):
    t = load(spark, SF001, register=True)
    register_sql_functions(spark)
    return t


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_call_matches_direct(spark, db):
    direct = get_orders(db["orders"], 7, "1996-01-01", "1998-01-01")
    via = call(spark, "get_orders", custkey=7, date_from="1996-01-01", date_to="1998-01-01")
    assert _rows(via) == _rows(direct)
    assert len(_rows(via)) == 4


def test_sql_table_function_matches_direct(spark, db):
    via = spark.sql("SELECT * FROM get_orders(7, DATE'1996-01-01', DATE'1998-01-01')")
    assert _rows(via) == _rows(get_orders(db["orders"], 7, "1996-01-01", "1998-01-01"))
    assert spark.sql("SELECT * FROM get_orders(7)").count() == get_orders(db["orders"], 7).count()


def test_errors(spark, db):
    with pytest.raises(ProcedureError):
        call(spark, "no_such_procedure")
    with pytest.raises(ProcedureError):
        call(spark, "get_orders")
    with pytest.raises(ProcedureError):
        call(spark, "get_orders", custkey=7, colour="red")


def test_every_procedure_runs(spark, db):
    batch = customer_batch(db["customer"])
    params = {"add_customers": {"batch": batch},
              "accept_orders": {"batch": db["orders"].withColumn("seq", db["orders"].o_orderkey)},
              "upsert_products": {"batch": db["part"]},
              "keep_products": {"batch": db["part"],
                                "out_path": scratch_dir(spark, "keep-products")},
              "keep_customers": {"batch": batch, "out_path": scratch_dir(spark, "keep-customers")},
              "keep_orders": {"batch": db["orders"].withColumn("seq", db["orders"].o_orderkey),
                              "out_path": scratch_dir(spark, "keep-orders")},
              "get_orders": {"custkey": 7}}
    for name in PROCEDURES:
        df = call(spark, name, **params.get(name, {}))
        assert df.count() > 0
    assert call(spark, "add_customers", batch=batch).count() == batch.count()


def test_keep_products_refuses_its_own_source(spark, db):
    with pytest.raises(ValueError, match="refusing"):
        call(spark, "keep_products", batch=db["part"], out_path=f"{SF001}/part.parquet")


def test_keep_products_writes_new_table(spark, db):
    from pyspark.sql import functions as F
    from stockroom.sources.batches import product_batch
    out = call(spark, "keep_products", batch=product_batch(db["part"]),
               out_path=scratch_dir(spark, "keep-products"))
    assert out.count() == 210
    assert out.select("p_partkey").distinct().count() == 210
    assert out.filter(F.col("p_partkey") == 0).first()["p_retailprice"] == \
        db["part"].filter(F.col("p_partkey") == 0).first()["p_retailprice"] + 1


def test_order_lines_of_matches_lineitem(spark, db):
    from pyspark.sql import functions as F
    k = db["orders"].first()["o_orderkey"]
    via = spark.sql(f"SELECT * FROM order_lines_of({k})")
    direct = (db["lineitem"].filter(F.col("l_orderkey") == k)
              .select("l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"))
    assert _rows(via) == _rows(direct) and len(_rows(via)) > 0
