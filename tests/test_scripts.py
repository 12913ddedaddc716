"""Storing procedures as SQL scripts, in a session that only speaks SQL."""

import uuid

import pytest

from stockroom.plans.procedures import call
from stockroom.plans.scripts import script
from stockroom.session import scratch_dir
from stockroom.sources import load
from stockroom.sources.batches import customer_batch, existing_customers
from tests.conftest import SF001


@pytest.fixture
def sql(spark):
    s = spark.newSession()
    t = load(s, SF001, register=False)
    existing_customers(t["customer"]).createOrReplaceTempView("customer")
    customer_batch(t["customer"]).createOrReplaceTempView("new_customers")
    t["nation"].createOrReplaceTempView("nation")
    return s


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_script_equals_call(sql):
    name = f"verdicts_{uuid.uuid4().hex[:8]}"
    sql.sql(script("add_customers", scratch_dir(sql, "script"), verdicts=name)).collect()
    want = call(sql, "add_customers", batch=sql.table("new_customers"))
    assert _rows(sql.sql(f"SELECT * FROM {name}").select(*want.columns)) == _rows(want)
    kept = call(sql, "keep_customers", batch=sql.table("new_customers"), out_path=scratch_dir(sql, "kept"))
    assert _rows(sql.sql("SELECT * FROM customers_after")) == _rows(kept)
    plan = sql.sql(f"EXPLAIN SELECT * FROM {name} WHERE verdict = 'accepted'").first()[0]
    assert "PartitionFilters: [isnotnull(verdict" in plan


def test_broken_seq_and_failure_leave_no_table(sql):
    name = f"verdicts_{uuid.uuid4().hex[:8]}"
    text = script("add_customers", scratch_dir(sql, "script"), verdicts=name)
    good = sql.table("new_customers")
    good.unionByName(good.limit(1)).createOrReplaceTempView("new_customers")
    with pytest.raises(Exception, match="repeat or have a null seq"):
        sql.sql(text).collect()
    assert not sql.catalog.tableExists(name)
    # a row that cannot be read ends the script behind its check; it may be run again
    good.selectExpr("c_custkey", "c_name", "c_nationkey", "if(c_custkey = 20, raise_error('simulated'), c_acctbal) AS c_acctbal",
                    "c_mktsegment", "seq").createOrReplaceTempView("new_customers")
    with pytest.raises(Exception, match="simulated"):
        sql.sql(text).collect()
    assert not sql.catalog.tableExists(name)
    good.createOrReplaceTempView("new_customers")
    sql.sql(script("add_customers", scratch_dir(sql, "script"), verdicts=name)).collect()
    assert sql.table(name).count() == good.count()


def test_names_are_checked():
    with pytest.raises(ValueError):
        script("add_customers", batch="x; DROP TABLE y")
    with pytest.raises(ValueError):
        script("drop_customers")
    with pytest.raises(ValueError):
        script("accept_orders", colour="red")
    assert "FROM lake.sales.incoming" in script("accept_orders", batch="lake.sales.incoming")
