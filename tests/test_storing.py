"""Storing procedures: all of a call or nothing, also when it fails anywhere."""

import pytest
from pyspark.sql import functions as F

from stockroom.plans.procedures import call
from stockroom.schemas import CUSTOMER, ORDERS, PART
from stockroom.session import scratch_dir
from stockroom.sources import stored
from stockroom.sources.batches import customer_batch, existing_customers, existing_orders, order_batch, product_batch
from stockroom.sources.manifest import ConflictError, Manifest
from stockroom.sources.stored import StoredTable
from stockroom import files


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def case(spark, tables001):
    c, o, p = tables001["customer"], tables001["orders"], tables001["part"]
    given = {"customer": existing_customers(c), "nation": tables001["nation"], "part": p}
    return {"keep_customers": (given, customer_batch(c), CUSTOMER),
            "keep_orders": ({"orders": existing_orders(o), "customer": c}, order_batch(o), ORDERS),
            "keep_products": (given, product_batch(p), PART)}


@pytest.mark.parametrize("name", ["keep_customers", "keep_orders", "keep_products"])
@pytest.mark.parametrize("step", ["write", "commit"])
def test_failed_call_changes_nothing_and_may_be_made_again(spark, case, monkeypatch, name, step):
    given, batch, schema = case[name]
    out = scratch_dir(spark, "test-storing")
    opened = given.__getitem__
    before = _rows(call(spark, name, opened, batch=batch.limit(0), out_path=out))
    table = StoredTable(spark, out, schema)
    version, still = table.version(), table.rows()

    def fails(*a, **k):
        raise OSError("simulated")
    with monkeypatch.context() as m:
        if step == "write":          # behind the write of the rows, ahead of the commit
            real = StoredTable.write
            m.setattr(StoredTable, "write", lambda self, rows, by: (real(self, rows, by), fails())[0])
        else:
            m.setattr(files, "rename_new", fails)
        with pytest.raises(OSError, match="simulated"):
            call(spark, name, opened, batch=batch, out_path=out)
    assert table.version() == version and _rows(table.rows()) == before == _rows(still)
    after = call(spark, name, opened, batch=batch, out_path=out)
    assert table.version() == version + 1 and after.count() > len(before)
    assert _rows(still) == before                       # who opened the old version keeps it
    assert table.vacuum() >= 1
    assert _rows(table.rows()) == _rows(after)


def test_rejected_and_accepted_rows_are_all_rows(spark, case):
    given, batch, _ = case["keep_customers"]
    out = scratch_dir(spark, "test-storing")
    after = call(spark, "keep_customers", given.__getitem__, batch=batch, out_path=out)
    refused = StoredTable(spark, out, CUSTOMER).refused()
    added = after.count() - given["customer"].count()
    assert added + refused.count() == batch.count()
    verdicts = {r["verdict"] for r in refused.select("verdict").distinct().collect()}
    assert verdicts == {"null_key", "duplicate_in_batch", "already_exists", "unknown_nation"}


def test_request_is_applied_once(spark, case):
    given, batch, _ = case["keep_customers"]
    out = scratch_dir(spark, "test-storing")
    for _ in range(3):
        after = call(spark, "keep_customers", given.__getitem__, batch=batch, out_path=out, request="landing 7")
    table = StoredTable(spark, out, CUSTOMER)
    assert table.version() == 0 and _rows(after) == _rows(table.rows())
    refused = table.refused().count()
    call(spark, "keep_customers", given.__getitem__, batch=batch, out_path=out, request="landing 8")
    assert table.version() == 1 and table.refused().count() == refused + batch.count()


def test_batch_that_comes_out_differently_each_time_is_taken_once(spark, tables001):
    nation = tables001["nation"]
    batch = spark.range(400).select(F.floor(F.rand() * 1000).cast("long").alias("c_custkey"), F.uuid().alias("c_name"),
                                    F.lit(1).alias("c_nationkey"), F.rand().alias("c_acctbal"), F.lit("S").alias("c_mktsegment"),
                                    F.col("id").alias("seq"))
    out = scratch_dir(spark, "test-storing")
    given = {"customer": tables001["customer"].limit(0), "nation": nation}
    after = call(spark, "keep_customers", given.__getitem__, batch=batch, out_path=out)
    refused = StoredTable(spark, out, CUSTOMER).refused()
    assert after.count() + refused.count() == 400
    seqs = [r["c_name"] for r in after.select("c_name").unionByName(refused.select("c_name")).collect()]
    assert len(set(seqs)) == 400 and after.select("c_custkey").distinct().count() == after.count()


def test_writer_that_lost_the_race_judges_again(spark, case, monkeypatch):
    given, batch, _ = case["keep_customers"]
    out = scratch_dir(spark, "test-storing")
    call(spark, "keep_customers", given.__getitem__, batch=batch.limit(0), out_path=out)
    real, raced = StoredTable.write, []

    def write(self, rows, by):
        got = real(self, rows, by)
        if not raced:                                   # the other writer brings the same batch in first
            raced.append(True)
            call(spark, "keep_customers", given.__getitem__, batch=batch, out_path=out)
        return got
    monkeypatch.setattr(StoredTable, "write", write)
    after = call(spark, "keep_customers", given.__getitem__, batch=batch, out_path=out)
    keys = [r[0] for r in after.select("c_custkey").collect()]
    assert raced and len(keys) == len(set(keys)) == given["customer"].count() + 15
    assert StoredTable(spark, out, CUSTOMER).version() == 2


def test_manifest_never_replaces_a_version(spark):
    m = Manifest(spark, scratch_dir(spark, "test-manifest"))
    assert m.latest() == (-1, {}) and m.commit({"x": 1}, -1) == 0
    with pytest.raises(ConflictError):
        m.commit({"x": 2}, -1)
    assert m.latest() == (0, {"x": 1})
    for v in range(30):
        m.commit({"x": v}, v)
    assert len(m.trim(5)) == 25 and m.versions() == [25, 26, 27, 28, 29, 30]
    assert not [n for n in files.child_names(spark, m.folder) if n.startswith("draft")]


def test_adopt_pack_and_vacuum(spark, case, tables001):
    given, batch, _ = case["keep_customers"]
    source, out = scratch_dir(spark, "test-adopted"), scratch_dir(spark, "test-storing")
    given["customer"].write.parquet(source)
    table = StoredTable(spark, out, CUSTOMER)
    table.adopt([source])
    for i in range(6):
        new = batch.withColumn("c_custkey", F.col("c_custkey") + (i + 1) * 10_000_000)
        call(spark, "keep_customers", given.__getitem__, batch=new, out_path=out)
    opened, rows = table.rows(), _rows(table.rows())
    n_files = sum(len(files.sizes(spark, table._at(d))) for d in table.manifest.latest()[1]["rows"])
    table.pack()
    doc = table.manifest.latest()[1]
    assert len(doc["rows"]) == 1 and len(files.sizes(spark, table._at(doc["rows"][0]))) == 1 < n_files
    assert _rows(opened) == _rows(table.rows()) == rows
    assert table.vacuum() == 0 and _rows(opened) == rows   # a kept version still names the old folders
    assert table.vacuum(keep=0) > 0 and _rows(table.rows()) == rows
    assert spark.read.parquet(source).count() == given["customer"].count()


def test_requests_that_are_remembered_are_bounded(spark, case, monkeypatch):
    given, batch, _ = case["keep_customers"]
    monkeypatch.setattr(stored, "REQUESTS", 2)
    out = scratch_dir(spark, "test-storing")
    for r in "abc":
        call(spark, "keep_customers", given.__getitem__, batch=batch.limit(1), out_path=out, request=r)
    assert StoredTable(spark, out, CUSTOMER).manifest.latest()[1]["requests"] == ["b", "c"]


def test_foreign_folder_is_refused(spark, case):
    given, batch, schema = case["keep_customers"]
    out = scratch_dir(spark, "test-storing")
    given["nation"].write.parquet(out)
    with pytest.raises(ValueError, match="refusing"):
        call(spark, "keep_customers", given.__getitem__, batch=batch, out_path=out)
    assert spark.read.parquet(out).count() == 25


def test_queries_leave_the_callers_views_alone(spark):
    from stockroom.plans.queries import QUERIES
    from tests.conftest import SF001
    spark.range(1).createOrReplaceTempView("customer")
    spark.range(2).createOrReplaceTempView("orders")
    try:
        for name, query in QUERIES.items():
            if not name.startswith("trigger"):
                query(spark, SF001)
        assert spark.table("customer").count() == 1 and spark.table("orders").count() == 2
    finally:
        spark.catalog.dropTempView("customer")
        spark.catalog.dropTempView("orders")


def test_store_that_fails_leaves_no_folder(spark, tables001, monkeypatch):
    from stockroom.operators import admission
    o = tables001["orders"]
    verdicts = admission.accept_orders(o.limit(0), o.limit(3).withColumn("seq", F.col("o_orderkey")), tables001["customer"])
    out = scratch_dir(spark, "test-store")

    def fails(*a):
        raise OSError("simulated")
    with monkeypatch.context() as m:
        m.setattr(files, "rename_new", fails)
        with pytest.raises(OSError):
            admission.store(verdicts, o.limit(0), out)
    assert not files.exists(spark, out)
    assert admission.store(verdicts, o.limit(0), out).count() == 3
    with pytest.raises(ValueError, match="refusing"):
        admission.store(verdicts, o.limit(0), out)
