"""Hand-made cases: bounds, sequence numbers, repeated keys, rates, shared folder."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stockroom.functions.money import line_amount
from stockroom.operators.admission import accept_orders, store
from stockroom.operators.orders import get_orders
from stockroom.operators.products import upsert_products
from stockroom.session import shared_dir


def test_bounds_of_all_kinds_agree_in_any_session_zone(spark, tables001):
    o = tables001["orders"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    counts = set()
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            for a, b in (("1996-01-01", "1998-01-01"), (dt.date(1996, 1, 1), dt.date(1998, 1, 1)),
                         (dt.datetime(1996, 1, 1), "1998-01-01 00:00:00")):
                counts.add(get_orders(o, 7, a, b).count())
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert counts == {4}
    with pytest.raises(ValueError):
        get_orders(o, 7, dt.datetime(1996, 1, 1, tzinfo=dt.timezone.utc))


@pytest.mark.parametrize("seqs", [(1, None), (1, 1)])
def test_null_or_tied_seq_is_refused(spark, tables001, seqs):
    batch = tables001["orders"].limit(1).withColumn("seq", F.explode(F.array(*[F.lit(s).cast("int") for s in seqs])))
    with pytest.raises(ValueError):
        accept_orders(tables001["orders"], batch, tables001["customer"])


def test_repeated_batch_keys_need_seq(spark, tables001):
    part = tables001["part"]
    with pytest.raises(ValueError):
        upsert_products(part, part.limit(2).unionByName(part.limit(2)))


def test_rates_keep_their_decimals(spark):
    df = spark.createDataFrame([(100.0, 0.055)], ["l_extendedprice", "l_discount"])
    assert float(df.select(line_amount()).first()[0]) == 94.5


def test_store_writes_table_and_rejected(spark, tables001, tmp_path):
    o = tables001["orders"]
    batch = o.limit(3).withColumn("seq", F.col("o_orderkey"))
    verdicts = accept_orders(o.limit(0), batch, tables001["customer"])
    assert store(verdicts, o.limit(0), str(tmp_path / "v1")).count() == 3
    again = accept_orders(o, batch, tables001["customer"])
    assert store(again, o, str(tmp_path / "v2")).count() == o.count()
    assert spark.read.parquet(str(tmp_path / "v2" / "rejected")).count() == 3


def test_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError):
        shared_dir(Session())
