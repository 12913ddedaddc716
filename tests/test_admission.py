"""O4 / O6 verdicts: hand-made rows, properties, and a brute-force model."""

import datetime as dt
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stockroom.operators import admission
from stockroom.operators.admission import add_customers, accept_orders, admit
from stockroom.schemas import CUSTOMER, NATION, ORDERS

BATCH = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string, seq long"


def _cust(spark, rows):
    return spark.createDataFrame(rows, CUSTOMER)


def _nation(spark):
    return spark.createDataFrame([(0, "A", 0), (1, "B", 0), (2, "C", 1)], NATION)


def _verdicts(df, key="c_custkey"):
    return {(r[key], r["seq"]): r["verdict"] for r in df.collect()}


@pytest.mark.parametrize("probe", [2_000_000, 0])
def test_hand_made_rows(spark, probe):
    existing = _cust(spark, [(1, "one", 0, 1.0, "X"), (2, "two", 1, 2.0, "X")])
    batch = spark.createDataFrame([
        (None, "n1", 0, 0.0, "X", 10),      # null key
        (None, "n2", 0, 0.0, "X", 11),      # another null key
        (1, "dup-exists", 0, 0.0, "X", 20), # exists
        (1, "dup-exists2", 0, 0.0, "X", 21),# later row of a rejected first row
        (5, "bad-nation", 9, 0.0, "X", 30), # unknown nation
        (5, "bad-nation2", 0, 0.0, "X", 31),# duplicate even though first is rejected
        (6, "ok", 2, 0.0, "X", 40),
        (6, "ok-again", 2, 0.0, "X", 39),   # lower seq wins, whatever the row order
        (7, "null-nation", None, 0.0, "X", 50),
    ], BATCH)
    v = admit(batch, key="c_custkey", seq="seq", existing=existing, existing_key="c_custkey",
              ref_col="c_nationkey", reference=_nation(spark), reference_key="n_nationkey",
              unknown="unknown_nation", small_reference=True, probe_max_rows=probe)
    got = _verdicts(v)
    assert got == {
        (None, 10): "null_key", (None, 11): "null_key",
        (1, 20): "already_exists", (1, 21): "duplicate_in_batch",
        (5, 30): "unknown_nation", (5, 31): "duplicate_in_batch",
        (6, 39): "accepted", (6, 40): "duplicate_in_batch",
        (7, 50): "unknown_nation",
    }
    assert v.count() == batch.count()


def test_orders_reference_customers(spark):
    customer = _cust(spark, [(1, "one", 0, 1.0, "X")])
    existing = spark.createDataFrame([(100, 1, "O", 1.0, dt.datetime(1996, 1, 1), "1")], ORDERS)
    batch = spark.createDataFrame([
        (100, 1, "O", 1.0, dt.datetime(1996, 1, 2), "1", 1),
        (101, 1, "O", 1.0, dt.datetime(1996, 1, 2), "1", 2),
        (102, 2, "O", 1.0, dt.datetime(1996, 1, 2), "1", 3),
        (101, 1, "O", 1.0, dt.datetime(1996, 1, 3), "1", 4),
    ], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
       "o_orderdate timestamp_ntz, o_orderpriority string, seq long")
    got = _verdicts(accept_orders(existing, batch, customer), key="o_orderkey")
    assert got == {(100, 1): "already_exists", (101, 2): "accepted",
                   (102, 3): "unknown_customer", (101, 4): "duplicate_in_batch"}


def _model(existing_keys, nations, rows):
    """Brute force: the verdict rules applied row by row."""
    firsts = {}
    for k, n, s in rows:
        if k is not None and (k not in firsts or s < firsts[k]):
            firsts[k] = s
    out = {}
    for k, n, s in rows:
        if k is None:
            v = "null_key"
        elif firsts[k] != s:
            v = "duplicate_in_batch"
        elif k in existing_keys:
            v = "already_exists"
        elif n not in nations:
            v = "unknown_nation"
        else:
            v = "accepted"
        out[(k, s)] = v
    return out


row = st.tuples(st.one_of(st.none(), st.integers(0, 12)), st.integers(0, 4))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=0, max_size=25), st.sets(st.integers(0, 12), max_size=6),
       st.booleans())
def test_matches_brute_force(spark, rows, existing_keys, small):
    seqd = [(k, n, i) for i, (k, n) in enumerate(rows)]
    batch = spark.createDataFrame([(k, "x", n, 0.0, "S", s) for k, n, s in seqd], BATCH)
    existing = _cust(spark, [(k, "e", 0, 0.0, "S") for k in sorted(existing_keys)])
    nation = _nation(spark)
    v = admit(batch, key="c_custkey", seq="seq", existing=existing, existing_key="c_custkey",
              ref_col="c_nationkey", reference=nation, reference_key="n_nationkey",
              unknown="unknown_nation", probe_max_rows=2_000_000 if small else 0)
    assert _verdicts(v) == _model(existing_keys, {0, 1, 2}, seqd)
    accepted = [r["c_custkey"] for r in v.filter("verdict = 'accepted'").collect()]
    assert len(accepted) == len(set(accepted))
    assert not set(accepted) & existing_keys


def test_add_customers_uses_default_seq(spark):
    existing = _cust(spark, [(1, "one", 0, 1.0, "X")])
    batch = spark.createDataFrame([(3, "three", 1, 0.0, "X", 1)], BATCH)
    assert _verdicts(add_customers(existing, batch, _nation(spark))) == {(3, 1): "accepted"}


@pytest.mark.parametrize("probe", [2_000_000, 0])
def test_hot_key_third_of_batch(spark, probe):
    """One key holds a third of the batch: exactly one row of it gets a real
    verdict, the rest are duplicates, and no window sorts the key as a whole."""
    import contextlib
    import io

    from pyspark.sql import functions as F
    n = 3000
    batch = (spark.range(n)
             .select(F.when(F.col("id") % 3 == 0, F.lit(42)).otherwise(F.col("id") + 1000)
                      .cast("long").alias("c_custkey"),
                     F.lit("x").alias("c_name"), (F.col("id") % 3).cast("int").alias("c_nationkey"),
                     F.lit(0.0).alias("c_acctbal"), F.lit("S").alias("c_mktsegment"),
                     (n - F.col("id")).alias("seq")))
    existing = _cust(spark, [(42, "hot", 0, 0.0, "S")])
    v = add_customers(existing, batch, _nation(spark)) if probe else admit(
        batch, key="c_custkey", seq="seq", existing=existing, existing_key="c_custkey",
        ref_col="c_nationkey", reference=_nation(spark), reference_key="n_nationkey",
        unknown="unknown_nation", probe_max_rows=0)
    got = {r["verdict"]: r["count"] for r in v.groupBy("verdict").count().collect()}
    assert got == {"already_exists": 1, "duplicate_in_batch": n // 3 - 1, "accepted": n - n // 3}
    hot_first = v.filter("c_custkey = 42 AND verdict = 'already_exists'").first()
    assert hot_first["seq"] == n - (n - 3)   # lowest seq of the hot key (largest id % 3 == 0)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        v.explain()
    assert "Window" not in buf.getvalue()


def test_only_null_keys(spark):
    existing = _cust(spark, [(1, "one", 0, 1.0, "X")])
    batch = spark.createDataFrame([(None, "a", 0, 0.0, "X", 1), (None, "b", 0, 0.0, "X", 2)], BATCH)
    assert _verdicts(add_customers(existing, batch, _nation(spark))) == {
        (None, 1): "null_key", (None, 2): "null_key"}


def test_check_seq_rejects_repeated_pairs(spark):
    existing = _cust(spark, [(1, "one", 0, 1.0, "X")])
    good = spark.createDataFrame([(3, "a", 1, 0.0, "X", 1), (3, "b", 1, 0.0, "X", 2)], BATCH)
    assert add_customers(existing, good, _nation(spark), check_seq=True).count() == 2
    bad = spark.createDataFrame([(3, "a", 1, 0.0, "X", 1), (3, "b", 1, 0.0, "X", 1)], BATCH)
    with pytest.raises(ValueError, match="seq must be unique"):
        add_customers(existing, bad, _nation(spark), check_seq=True)


def test_landed_rows_are_dealt_by_their_number(spark, monkeypatch):
    """Tasks follow the rows of a batch, and a hot key spreads; verdicts are
    those of files that come one by one, null keys included."""
    monkeypatch.setattr(admission, "PART_ROWS", 100)
    paths = ["/z/" + "long" * 40, "/a/" + "long" * 40, "/m/" + "long" * 40]     # names against arrival
    when = dt.datetime(2024, 1, 1)
    rows = []
    for f, path in enumerate(paths):
        for i in range(1000):
            key = None if i % 50 == 7 else 5 if i % 3 == 0 else i + 300 * f
            ref = 1 if (i + f) % 4 else 99
            rows.append((key, ref, "x" * 30, (when + dt.timedelta(seconds=f), path, i)))
    schema = "k long, ref long, note string, landed struct<time: timestamp, file: string, row: long>"
    batch = spark.createDataFrame(rows, schema)
    known = spark.createDataFrame([(310,), (620,)], "k long")
    got = admission.admit_landed(batch, key="k", landed="landed", existing=known, existing_key="k", ref_col="ref",
                                 reference=spark.createDataFrame([(1,)], "id long"), reference_key="id", unknown="unknown")
    assert got.columns == batch.columns + ["verdict"]
    out = got.withColumn("part", F.spark_partition_id()).collect()
    want, taken = {}, {310, 620}
    for f in range(3):
        seen = set()
        for key, ref, _, (_, path, i) in rows[f * 1000:(f + 1) * 1000]:
            if key is None:
                v = "null_key"
            elif key in seen:
                v = "duplicate_in_batch"
            elif key in taken:
                v = "already_exists"
            else:
                v = "accepted" if ref == 1 else "unknown"
            seen.add(key)
            if v == "accepted":
                taken.add(key)
            want[path, i] = (key, v)
    assert len(out) == 3000 and {(r.landed.file, r.landed.row): (r.k, r.verdict) for r in out} == want
    assert {(r.landed.file, r.landed.time) for r in out} == {(p, when + dt.timedelta(seconds=f)) for f, p in enumerate(paths)}
    assert max(Counter(r.part for r in out).values()) < 300
