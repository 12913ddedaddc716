"""Folding of a trigger's output: how much is rewritten, what is opened, and
that readers and results do not notice."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockroom.schemas import ORDERS
from stockroom.session import scratch_dir
from stockroom.streaming import (ORDER_RULES, InsertTrigger, accepted_rows, audit_log, files, kept_totals, rejected_rows,
                                 segments)
from stockroom.streaming import keyfilters as kf
from stockroom.streaming import triggers

N = 100       # batches
EVERY = 4     # of them in a round


def _trigger(spark, customer, compact_every=None):
    work = scratch_dir(spark, "test-segments")
    return InsertTrigger(spark, f"{work}/in", f"{work}/out", ORDER_RULES, reference=customer, compact_every=compact_every)


def _written(spark, trig, orders, n):
    """What ``n`` batches of the trigger write, each key with a batch of its
    own; every tenth row is refused."""
    b = F.pmod(F.xxhash64("o_orderkey"), F.lit(n))
    rows = orders.withColumn("batch_id", b).withColumn(
        "verdict", F.when(F.col("o_orderkey") % 10 == 3, "unknown_customer").otherwise("accepted"))
    landed = F.struct(F.lit("2026-01-01").cast("timestamp").alias("time"), F.lit("f").alias("file"), F.col("o_orderkey").alias("row"))
    (rows.withColumn("landed", landed).repartition("batch_id").write.partitionBy("batch_id", "verdict").parquet(f"{trig.out_dir}/rows"))
    log = rows.select(F.col("o_orderkey").alias("key"), "verdict", F.lit("f").alias("landed_file"),
                      F.col("o_orderkey").alias("landed_row"), F.col("batch_id").cast("long").alias("batch_id"), b.alias("b"))
    log.repartition("b").write.partitionBy("b").parquet(f"{trig.out_dir}/audit")
    sums = (rows.filter("verdict = 'accepted'").groupBy("batch_id", "o_custkey")
            .agg(F.count("*").alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(28,2)")).cast("decimal(38,2)").alias("total_price"),
                 F.max("o_orderdate").alias("last_order_date"), F.lit(0).cast("long").alias("n_unfit")))
    sums.repartition("batch_id").write.partitionBy("batch_id").parquet(f"{trig.out_dir}/totals")
    fs, _ = files._fs(spark, trig.out_dir)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for i in range(n):
        if files.exists(spark, f"{trig.out_dir}/audit/b={i}"):
            fs.rename(path(f"{trig.out_dir}/audit/b={i}"), path(f"{trig.out_dir}/audit/batch_id={i}"))
    return rows


def _commit(spark, trig, upto, since=-1):
    for i in range(since + 1, upto + 1):
        files.write_text(spark, f"{trig.checkpoint}/commits/{i}", "v1")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rewritten_rows_grow_with_the_logarithm_and_files_stay_few(spark, tables001, monkeypatch):
    trig = _trigger(spark, tables001["customer"])
    _written(spark, trig, tables001["orders"], N)
    _commit(spark, trig, N - 1)
    want = {f: _rows(f(spark, trig.out_dir)) for f in (accepted_rows, rejected_rows, audit_log, kept_totals)}
    assert len(want[audit_log]) == 1500 and len(want[rejected_rows]) == 150
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = f"{trig.checkpoint}/commits"
    fs, _ = files._fs(spark, folder)
    fs.delete(path(folder), True)
    monkeypatch.setattr(segments, "FULL_BYTES", 1 << 62)
    written = {"keys": 0, "audit": 0}
    for r in range(N // EVERY):
        before = {w: {s["name"] for s in triggers.segments_of(spark, trig.out_dir, w).current()[1]} for w in written}
        _commit(spark, trig, (r + 1) * EVERY - 1, r * EVERY - 1)
        assert trig.compact() == (r + 1) * EVERY - 1
        for w in written:
            at = triggers.segments_of(spark, trig.out_dir, w)
            for s in at.current()[1]:
                if s["name"] not in before[w]:
                    written[w] += spark.read.parquet(at.path(s) + ("/keys" if w == "keys" else "")).count()
    levels = math.ceil(math.log(N / EVERY, segments.FANOUT)) + 1
    assert written["keys"] <= 1350 * levels and written["audit"] <= 1500 * levels
    for w in ("keys", "totals", "audit", "rows"):
        at = triggers.segments_of(spark, trig.out_dir, w)
        assert len(at.current()[1]) <= (segments.FANOUT - 1) * levels
    n_files = len(files.sizes(spark, f"{trig.out_dir}/segments/audit")) + len(files.sizes(spark, f"{trig.out_dir}/audit"))
    assert n_files <= 2 * segments.FANOUT * levels + 2 * EVERY < N
    left = [n for n in files.child_names(spark, f"{trig.out_dir}/rows") if n.startswith("batch_id=")]
    assert len(left) <= 2 * EVERY                  # folders of folded batches go a round later
    assert {f: _rows(f(spark, trig.out_dir)) for f in want} == want


def test_readers_survive_a_round(spark, tables001):
    trig = _trigger(spark, tables001["customer"])
    _written(spark, trig, tables001["orders"], 12)
    _commit(spark, trig, 7)
    want = {f: _rows(f(spark, trig.out_dir)) for f in (accepted_rows, rejected_rows, audit_log, kept_totals)}
    opened = {f: f(spark, trig.out_dir) for f in want}
    trig.compact()
    assert {f: _rows(d) for f, d in opened.items()} == want
    assert {f: _rows(f(spark, trig.out_dir)) for f in want} == want
    opened = {f: f(spark, trig.out_dir) for f in want}
    _commit(spark, trig, 11, 7)
    trig.compact()
    assert {f: _rows(d) for f, d in opened.items()} == want
    assert audit_log(spark, trig.out_dir).count() == 1500


@pytest.mark.parametrize("at", ["keys", "audit", "rows"])
def test_failed_round_changes_nothing_and_is_made_up_for(spark, tables001, monkeypatch, at):
    trig = _trigger(spark, tables001["customer"])
    _written(spark, trig, tables001["orders"], 8)
    _commit(spark, trig, 3)
    trig.compact()
    _commit(spark, trig, 7, 3)
    want = {f: _rows(f(spark, trig.out_dir)) for f in (accepted_rows, audit_log, kept_totals)}
    real = segments.Manifest.commit

    def fails(self, doc, after):
        if f"/segments/{at}/" in self.folder:
            raise OSError("simulated")
        return real(self, doc, after)
    with monkeypatch.context() as m:
        m.setattr(segments.Manifest, "commit", fails)
        with pytest.raises(OSError, match="simulated"):
            trig.compact()
    assert {f: _rows(f(spark, trig.out_dir)) for f in want} == want
    assert trig.compact() == 7
    assert {f: _rows(f(spark, trig.out_dir)) for f in want} == want
    assert {w: triggers.segments_of(spark, trig.out_dir, w).current()[0] for w in ("keys", "totals", "audit", "rows")} == \
        dict.fromkeys(("keys", "totals", "audit", "rows"), 7)


def test_random_keys_open_few_key_files(spark, monkeypatch):
    r = random.Random(3)
    monkeypatch.setattr(kf, "PART_KEYS", 500)
    keys = r.sample(range(10 ** 12), 20_500)
    old, new = keys[:20_000], keys[20_000:]
    df = spark.createDataFrame([(k,) for k in old], "o_orderkey long")
    path = scratch_dir(spark, "test-filters")
    kf.write_parts(df, "o_orderkey", path, 500)
    assert spark.read.parquet(f"{path}/keys").count() == 20_000
    probe = spark.createDataFrame([(k,) for k in new[:200]], "o_orderkey long")
    opened, total = kf.parts_with([path], probe, "o_orderkey")
    assert total == 40 and len(opened) <= 8            # statistics alone would open nearly all
    some = spark.createDataFrame([(k,) for k in old[::4000]], "o_orderkey long")
    opened, _ = kf.parts_with([path], some, "o_orderkey")
    found = {x[0] for x in spark.read.parquet(*opened).select("o_orderkey").collect()}
    assert set(old[::4000]) <= found and len(opened) <= 13
    assert kf.parts_with([path], probe.limit(0), "o_orderkey") == ([], 40)
    assert kf.parts_with([], probe, "o_orderkey") == ([], 0)


def test_filter_has_no_false_negatives_and_few_false_positives():
    r = np.random.default_rng(1)
    h = r.integers(-2 ** 63, 2 ** 63 - 1, 20_000)
    raw = kf.make_filter(h[:10_000])
    assert kf.may_hold(raw, 10_000, h[:10_000]).all()
    assert kf.may_hold(raw, 10_000, h[10_000:]).mean() < 0.005
    assert not kf.may_hold(kf.make_filter(h[:0]), 0, h).any()


def test_stream_over_segments_gives_the_verdicts_of_one_run(spark, tables001):
    """Random keys land in many files; folded every second batch, with old
    keys coming again; the log equals that of a trigger that never folds."""
    orders = tables001["orders"].withColumn("o_orderkey", F.abs(F.xxhash64("o_orderkey")))
    part = F.pmod(F.col("o_orderkey"), F.lit(8))
    logs = []
    for every in (2, None):
        trig = _trigger(spark, tables001["customer"], every)
        for i in range(8):
            (orders.filter((part == i) | ((part < i) & (F.pmod(F.col("o_orderkey"), F.lit(50)) == 5)))
             .select(*ORDERS.fieldNames()).coalesce(1).write.parquet(f"{trig.in_dir}/{i}"))
            trig.run_available()
        logs.append(_rows(audit_log(spark, trig.out_dir).select("key", "verdict", "batch_id")))
        if every:
            assert triggers.segments_of(spark, trig.out_dir, "keys").current()[0] >= 4
            assert any(total for _, total in trig.opened.values())
    assert logs[0] == logs[1] and any(v == "already_exists" for _, v, _ in logs[0])
