"""O10-O12: the insert triggers, including a replayed batch."""

import pytest
from pyspark.sql import functions as F

from stockroom.operators.totals import order_totals_partial
from stockroom.schemas import CUSTOMER
from stockroom.session import scratch_dir
from stockroom.streaming import (CUSTOMER_RULES, ORDER_RULES, InsertTrigger, accepted_rows,
                                 audit_log, kept_totals)
from stockroom.streaming.triggers import LANDED


def _landed(spark, path, rules):
    return (spark.read.schema(rules.schema).parquet(path)
            .select("*", F.struct(F.col("_metadata.file_modification_time").alias("time"),
                                  F.col("_metadata.file_path").alias("file"),
                                  F.col("_metadata.row_index").alias("row")).alias(LANDED)))


def test_two_files_then_replay(spark, tables001):
    work = scratch_dir(spark, "test-trigger")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    orders = tables001["orders"]
    trig = InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"])
    orders.filter(F.col("o_orderkey") < 100).write.parquet(f"{in_dir}/0")
    trig.run_available()
    orders.filter(F.col("o_orderkey").between(90, 149)).write.parquet(f"{in_dir}/1")
    trig.run_available()

    acc = accepted_rows(spark, out_dir)
    assert acc.count() == 150
    assert acc.select("o_orderkey").distinct().count() == 150
    audit = {(r["batch_id"], r["verdict"]): r["count"]
             for r in audit_log(spark, out_dir).groupBy("batch_id", "verdict").count().collect()}
    assert audit == {(0, "accepted"): 100, (1, "accepted"): 50, (1, "already_exists"): 10}

    # a crash after the writes of batch 1 and before its commit: Spark runs it again
    trig.handle(_landed(spark, f"{in_dir}/1", ORDER_RULES), 1)
    assert accepted_rows(spark, out_dir).count() == 150
    assert audit_log(spark, out_dir).count() == 160

    # O12: partials per batch equal a full recompute
    want = order_totals_partial(orders.filter(F.col("o_orderkey") < 150))
    got = kept_totals(spark, out_dir)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # a third file arrives later: only it is processed
    orders.filter(F.col("o_orderkey").between(140, 199)).write.parquet(f"{in_dir}/2")
    trig.run_available()
    assert accepted_rows(spark, out_dir).count() == 200


def test_new_checkpoint_over_old_output_is_refused(spark, tables001):
    work = scratch_dir(spark, "test-trigger-ckpt")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    tables001["orders"].filter(F.col("o_orderkey") < 10).write.parquet(f"{in_dir}/0")
    InsertTrigger(spark, in_dir, out_dir, ORDER_RULES,
                  reference=tables001["customer"]).run_available()
    with pytest.raises(RuntimeError, match="checkpoint"):
        InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"],
                      checkpoint=f"{work}/other-checkpoint").start()


def test_customer_trigger_against_base_table(spark, tables001):
    work = scratch_dir(spark, "test-trigger-cust")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    base = tables001["customer"]
    spark.createDataFrame([
        (0, "exists", 1, 0.0, "S"),
        (5000, "new", 1, 0.0, "S"),
        (5001, "no nation", 99, 0.0, "S"),
        (None, "no key", 1, 0.0, "S"),
    ], CUSTOMER).coalesce(1).write.parquet(f"{in_dir}/0")
    InsertTrigger(spark, in_dir, out_dir, CUSTOMER_RULES, reference=tables001["nation"],
                  base=base).run_available()
    got = {r["key"]: r["verdict"] for r in audit_log(spark, out_dir).collect()}
    assert got == {0: "already_exists", 5000: "accepted", 5001: "unknown_nation",
                   None: "null_key"}
    assert [r["c_custkey"] for r in accepted_rows(spark, out_dir, CUSTOMER_RULES).collect()] == [5000]


class _CrashAfterWrites(InsertTrigger):
    """Fails batch 1 after all its writes, before Spark can commit it."""

    def handle(self, batch, batch_id):
        super().handle(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("simulated crash before commit")


def test_replay_through_checkpoint(spark, tables001):
    work = scratch_dir(spark, "test-trigger-crash")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    orders, customer = tables001["orders"], tables001["customer"]
    orders.filter(F.col("o_orderkey") < 100).write.parquet(f"{in_dir}/0")
    InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=customer).run_available()
    orders.filter(F.col("o_orderkey").between(90, 149)).write.parquet(f"{in_dir}/1")
    with pytest.raises(Exception, match="simulated crash"):
        _CrashAfterWrites(spark, in_dir, out_dir, ORDER_RULES, reference=customer).run_available()
    # batch 1's rows are written but not committed: no reader shows them, and
    # a restart runs batch 1 again
    assert accepted_rows(spark, out_dir).count() == 100
    assert audit_log(spark, out_dir).count() == 100
    assert kept_totals(spark, out_dir).agg(F.sum("n_orders")).first()[0] == 100
    InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=customer).run_available()
    acc = accepted_rows(spark, out_dir)
    assert acc.count() == 150
    assert {r["batch_id"] for r in acc.select("batch_id").distinct().collect()} == {0, 1}

    # Without the batch_id < N guard the replay would find its own rows:
    # all 50 new keys of batch 1 would be rejected as already existing.
    from stockroom.operators.admission import admit
    unguarded = admit(_landed(spark, f"{in_dir}/1", ORDER_RULES), key="o_orderkey", seq=LANDED,
                      existing=accepted_rows(spark, out_dir), existing_key="o_orderkey",
                      ref_col="o_custkey", reference=customer, reference_key="c_custkey",
                      unknown="unknown_customer")
    assert unguarded.filter("verdict = 'accepted'").count() == 0


class _CrashFirstBatch(InsertTrigger):
    def handle(self, batch, batch_id):
        super().handle(batch, batch_id)
        raise RuntimeError("simulated crash in the first batch")


def test_restart_after_crash_in_first_batch(spark, tables001):
    work = scratch_dir(spark, "test-trigger-crash0")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    tables001["orders"].filter(F.col("o_orderkey") < 40).write.parquet(f"{in_dir}/0")
    with pytest.raises(Exception, match="simulated crash"):
        _CrashFirstBatch(spark, in_dir, out_dir, ORDER_RULES,
                         reference=tables001["customer"]).run_available()
    # batch 0 was planned (offsets) but not committed: the restart is not refused
    InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"]).run_available()
    assert accepted_rows(spark, out_dir).count() == 40


def test_empty_landing_and_no_landing(spark, tables001):
    work = scratch_dir(spark, "test-trigger-empty")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    trig = InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"])
    spark.createDataFrame([], ORDER_RULES.schema).write.parquet(f"{in_dir}/0")
    trig.run_available()
    trig.run_available()            # nothing new: no batch
    assert accepted_rows(spark, out_dir).count() == 0
    assert kept_totals(spark, out_dir).count() == 0
    tables001["orders"].filter(F.col("o_orderkey") < 5).write.parquet(f"{in_dir}/1")
    trig.run_available()
    assert accepted_rows(spark, out_dir).count() == 5


def test_compaction_keeps_results(spark, tables001):
    from stockroom.streaming.triggers import segments_of
    work = scratch_dir(spark, "test-trigger-compact")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    orders = tables001["orders"]
    trig = InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"])
    k = F.col("o_orderkey")

    def land(i, lo, hi):
        orders.filter(k.between(lo, hi)).write.parquet(f"{in_dir}/{i}")
        trig.run_available()

    def verdicts(batch_id):
        return {r["verdict"]: r["count"] for r in audit_log(spark, out_dir)
                .filter(F.col("batch_id") == batch_id).groupBy("verdict").count().collect()}

    def totals_match(hi):
        want = order_totals_partial(orders.filter(k <= hi))
        got = kept_totals(spark, out_dir)
        return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    land(0, 0, 59)
    land(1, 50, 109)
    assert trig.compact() == 1
    assert segments_of(spark, out_dir, "keys").current()[0] == 1
    assert totals_match(109)
    land(2, 100, 159)            # its repeats are found through the key segment
    assert verdicts(2) == {"accepted": 50, "already_exists": 10}
    assert totals_match(159)
    assert trig.compact() == 2   # incremental: batch 2 alone
    assert trig.compact() == 2   # nothing new committed
    at = segments_of(spark, out_dir, "keys")
    assert [(s["lo"], s["hi"]) for s in at.current()[1]] == [(0, 1), (2, 2)]
    keys = spark.read.option("recursiveFileLookup", "true").parquet(*[f"{at.path(s)}/keys" for s in at.current()[1]]).select("o_orderkey")
    assert keys.count() == 160 and keys.distinct().count() == 160
    land(3, 150, 199)
    assert verdicts(3) == {"accepted": 40, "already_exists": 10}
    assert accepted_rows(spark, out_dir).count() == 200
    assert totals_match(199)


def test_continuous_stream_and_sql_views(spark, tables001):
    from stockroom.streaming import register_trigger_views
    work = scratch_dir(spark, "test-trigger-live")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    orders = tables001["orders"]
    k = F.col("o_orderkey")
    orders.filter(k < 30).write.parquet(f"{in_dir}/0")
    q = InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"]) \
        .start(available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        orders.filter(k.between(20, 49)).write.parquet(f"{in_dir}/1")
        q.processAllAvailable()
    finally:
        q.stop()
    register_trigger_views(spark, out_dir, prefix="live_orders")
    assert spark.sql("SELECT count(*) AS n FROM live_orders_accepted").first()["n"] == 50
    assert spark.sql("SELECT count(*) AS n FROM live_orders_audit "
                     "WHERE verdict = 'already_exists'").first()["n"] == 10
    assert spark.sql("SELECT sum(n_orders) AS n FROM live_orders_kept_totals").first()["n"] == 50


def test_max_files_per_trigger_splits_batches(spark, tables001):
    work = scratch_dir(spark, "test-trigger-maxfiles")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    orders = tables001["orders"]
    k = F.col("o_orderkey")
    for i, (lo, hi) in enumerate([(0, 19), (10, 29), (25, 39)]):
        orders.filter(k.between(lo, hi)).coalesce(1).write.parquet(f"{in_dir}/{i}")
    InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"],
                  max_files_per_trigger=1).run_available()
    audit = audit_log(spark, out_dir)
    assert {r["batch_id"] for r in audit.select("batch_id").distinct().collect()} == {0, 1, 2}
    assert accepted_rows(spark, out_dir).count() == 40
    assert audit.filter("verdict = 'already_exists'").count() == 15


def test_on_insert_and_order_totals(spark, tables001):
    from stockroom.operators.totals import order_totals
    from stockroom.streaming import on_insert
    work = scratch_dir(spark, "test-on-insert")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    orders = tables001["orders"]
    k = F.col("o_orderkey")
    orders.filter(k < 50).write.parquet(f"{in_dir}/0")
    q = on_insert(spark, in_dir, out_dir, reference=tables001["customer"])
    q.awaitTermination()
    want = order_totals(orders.filter(k < 25), orders.filter(k.between(25, 49)))
    got = kept_totals(spark, out_dir)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _order(key, cust, price=1.0):
    from datetime import datetime
    return (key, cust, "O", price, datetime(1996, 1, 1), "1-URGENT")


@pytest.mark.parametrize("cap", [None, 1, 2])
def test_verdicts_do_not_depend_on_the_cut(spark, tables001, cap):
    import time
    work = scratch_dir(spark, "test-trigger-cut")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    # names against arrival; key 1 is first refused; key 2 comes twice in a file
    landings = [("c", [_order(1, -5), _order(2, 1, 10.0), _order(2, 1, 11.0)]),
                ("b", [_order(1, 1, 20.0), _order(2, 1, 12.0), _order(3, 1, 1e11)]),
                ("a", [_order(1, 1, 30.0), _order(3, 1, 5.0), _order(None, 1)])]
    for name, rows in landings:
        spark.createDataFrame(rows, ORDER_RULES.schema).coalesce(1).write.parquet(f"{in_dir}/{name}")
        time.sleep(0.02)
    InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"],
                  max_files_per_trigger=cap).run_available()
    got = sorted((r["o_orderkey"], r["o_totalprice"]) for r in accepted_rows(spark, out_dir).collect())
    assert got == [(1, 20.0), (2, 10.0), (3, 5.0)]
    verdicts = sorted((r["key"] or 0, r["verdict"]) for r in audit_log(spark, out_dir).collect())
    assert verdicts == [(0, "null_key"), (1, "accepted"), (1, "already_exists"), (1, "unknown_customer"),
                        (2, "accepted"), (2, "already_exists"), (2, "duplicate_in_batch"),
                        (3, "accepted"), (3, "bad_value")]
    assert kept_totals(spark, out_dir).agg(F.sum("total_price")).first()[0] == 35


def test_reference_is_opened_for_each_batch(spark):
    work = scratch_dir(spark, "test-trigger-ref")
    in_dir, out_dir, ref = f"{work}/in", f"{work}/out", f"{work}/customer"
    spark.createDataFrame([(1, "a", 1, 0.0, "S")], CUSTOMER).write.parquet(ref)
    trig = InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=ref)
    for i, key in enumerate((10, 11)):
        spark.createDataFrame([_order(key, 2)], ORDER_RULES.schema).write.parquet(f"{in_dir}/{i}")
        trig.run_available()
        spark.createDataFrame([(2, "b", 1, 0.0, "S")], CUSTOMER).write.mode("append").parquet(ref)
    assert [r["o_orderkey"] for r in accepted_rows(spark, out_dir).collect()] == [11]


def test_compaction_runs_by_itself_and_bounds_what_is_listed(spark, tables001):
    from stockroom import files
    from stockroom.streaming.triggers import segments_of
    work = scratch_dir(spark, "test-trigger-auto")
    in_dir, out_dir = f"{work}/in", f"{work}/out"
    k = F.col("o_orderkey")
    trig = InsertTrigger(spark, in_dir, out_dir, ORDER_RULES, reference=tables001["customer"], compact_every=2)
    for i in range(7):
        tables001["orders"].filter(k.between(10 * i, 10 * i + 14)).coalesce(1).write.parquet(f"{in_dir}/{i}")
        trig.run_available()
        at = segments_of(spark, out_dir, "keys")
        done, segments = at.current()
        assert i - done <= 2
        assert len(files.child_names(spark, f"{at.folder}/data")) <= 2 * at.fanout
        inputs = trig.existing_keys(i + 1).inputFiles()
        assert not [f for f in inputs for b in range(0, done + 1) if f"batch_id={b}/" in f]
    assert accepted_rows(spark, out_dir).count() == 75
    assert kept_totals(spark, out_dir).agg(F.sum("n_orders")).first()[0] == 75
    assert audit_log(spark, out_dir).count() == 105
