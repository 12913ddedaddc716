"""O4 add customers and O6 accept orders: one verdict per incoming row.

Plain parquet enforces no key or reference, so every batch row gets a
verdict, the first that applies in this fixed order:

1. ``null_key``            the key is null
2. ``duplicate_in_batch``  another row of the batch has the same key and a
                           lower ``seq`` (even if that row is itself rejected)
3. ``already_exists``      the key is in the existing table
4. ``unknown_<ref>``       the reference value is not in the reference table
5. ``bad_value``           (orders) a price that is no price (functions.money)
6. ``accepted``

Every input row appears exactly once in the output.

Plan shape, chosen so that one key holding a third of the batch never
lands on one task, and so that the existing and reference tables (which
grow with the warehouse) are scanned but not shuffled for a bounded batch:

* the batch is read once and written to scratch; whatever follows reads that,
  so size checks, key ranges and verdicts speak of the same rows even if the
  batch would not come out the same twice;
* null keys are split off first (a shuffle sends all nulls to one task);
* the first row of each key is found by ``min(seq)`` / ``min_by(ref, seq)``
  grouped by key: a hash aggregate with map-side partial combine, so a hot
  key collapses before the shuffle.  The first rows (key, seq, reference) are
  written once as well and read by the size check and by all probes;
* if their number passes the size check, their keys and reference values are
  broadcast and probed against the existing and
  reference tables (semi joins over a scan, no shuffle of the big side),
  and the scans carry the first rows' key range as a pushed filter so parquet
  skips row groups that cannot match.  The hits are at most as many as the
  probe, so joining them back is a broadcast too;
* above the bound the first rows go through shuffled semi / anti joins
  against the existing and reference tables; their children are plain
  shuffles, so AQE can split the partition of a hot reference value;
* the verdicts are joined back to the batch on ``(key, seq)``, unique per
  row, so the rows of a hot key spread over all partitions.

``seq`` must be non-null and unique among the rows of a key (an insertion
number).  The aggregate that finds the first rows goes by ``(key, seq)``
first and counts on the way; a batch that breaks the rule is refused: no
verdict would be right for it.  It may be any orderable column, a struct
included (then the aggregate sorts instead of hashing).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockroom import files
from stockroom.functions.money import is_price
from stockroom.plans.joins import LOOKUP_MAX_ROWS, keys_present, probe_limit, row_count_at_most
from stockroom.session import materialise

VERDICT = "verdict"
NULL_KEY = "null_key"
DUPLICATE = "duplicate_in_batch"
EXISTS = "already_exists"
BAD_VALUE = "bad_value"
ACCEPTED = "accepted"

PART_ROWS = 400_000   # landed rows of a task
SMALL_PARTS = 4       # so many times that is a small batch
SPREAD = 16           # tasks that share the rows of a hot key


def admit(batch: DataFrame, *, key: str, seq: str, existing: DataFrame, existing_key: str,
          ref_col: str, reference: DataFrame, reference_key: str, unknown: str,
          small_reference: bool = False, money_col: str | None = None, probe_max_rows: int | None = None,
          check_seq: bool = True, scratch: str | None = None) -> DataFrame:
    """Batch rows with a ``verdict`` column (see module doc).

    ``existing`` may be any frame holding the keys already present.
    ``small_reference`` marks a lookup table (such as nations) that is
    broadcast when its own size check allows.  ``money_col`` must hold a
    price or null.  ``check_seq`` verifies that ``seq`` is never null and
    ``(key, seq)`` unique and raises ``ValueError`` otherwise.  Pass False
    only for a ``seq`` that is unique by how it is made, such as a file and
    row number.  ``scratch`` is a scratch folder of the caller's own, to be
    removed once the verdicts are written.
    """
    batch = materialise(batch, "batch", scratch)
    nulls = batch.filter(F.col(key).isNull()).withColumn(VERDICT, F.lit(NULL_KEY))
    keyed = batch.filter(F.col(key).isNotNull())

    fits = is_price(money_col) if money_col else F.lit(True)
    rows = keyed.select(key, seq, F.col(ref_col).alias("_ref"), fits.alias("_fits"), F.lit(0).alias("_bad"))
    if check_seq:
        # by (key, seq): a hot key still spreads, and repeats show
        rows = (rows.groupBy(key, seq)
                .agg(F.max("_ref").alias("_ref"), F.min("_fits").alias("_fits"), F.count(F.lit(1)).alias("_n"))
                .withColumn("_bad", F.when((F.col("_n") > 1) | F.col(seq).isNull(), 1).otherwise(0)))
    first = materialise(rows.groupBy(key).agg(F.min(seq).alias(seq), F.min_by("_ref", seq).alias("_ref"),
                                              F.min_by("_fits", seq).alias("_fits"), F.sum("_bad").alias("_bad")),
                        "first-rows", scratch)
    if check_seq and (bad := first.agg(F.sum("_bad")).first()[0]):
        raise ValueError(f"{bad} (key, seq) pair(s) repeat or have a null seq; seq must be unique and not null")
    decided = judge(first, key=key, existing=existing, existing_key=existing_key, ref_col=ref_col,
                    reference=reference, reference_key=reference_key, unknown=unknown,
                    small_reference=small_reference, probe_max_rows=probe_max_rows).select(key, seq, VERDICT)
    # ``decided`` holds seq (for streams: file names), so its broadcast is
    # left to AQE's measured size; the join back is batch-sized either way.
    judged = (keyed.join(decided, [key, seq], "left")
                   .withColumn(VERDICT, F.coalesce(F.col(VERDICT), F.lit(DUPLICATE))))
    cols = batch.columns + [VERDICT]
    return judged.select(*cols).unionByName(nulls.select(*cols))


def judge(first: DataFrame, *, key: str, existing: DataFrame | Callable[[DataFrame, int], DataFrame], existing_key: str,
          ref_col: str, reference: DataFrame, reference_key: str, unknown: str,
          small_reference: bool = False, probe_max_rows: int | None = None) -> DataFrame:
    """``first`` (``key``, ``_ref``, ``_fits`` and other columns; written to
    scratch, as it is read several times) with the verdict each row has on
    its own: already there, unknown reference, bad value, or accepted.
    ``existing`` may be a function of the first keys and their number that
    gives a frame with at least those of them that exist."""
    # One scan of the first rows; five numbers reach the driver.
    st = first.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("k0"), F.max(key).alias("k1"),
                   F.min("_ref").alias("r0"), F.max("_ref").alias("r1")).first()
    if callable(existing):
        existing = existing(first.select(key), st["n"])
    known = existing.select(F.col(existing_key).alias(key))
    ref_all = reference.select(F.col(reference_key).alias("_ref"))
    good = F.when(F.col("_fits"), F.lit(ACCEPTED)).otherwise(F.lit(BAD_VALUE))
    if st["n"] <= probe_limit(first.sparkSession, probe_max_rows):
        # Probe hits are at most as many as the first rows: broadcast them
        # back and label the first rows with two broadcast joins.
        seen = keys_present(known, first, key, True, key_range=(st["k0"], st["k1"]))
        # the probe may repeat a value; its size is bounded by the check above
        found = keys_present(ref_all, first.select("_ref"), "_ref", True,
                             key_range=(st["r0"], st["r1"]))
        verdict = (F.when(F.col("_exists").isNotNull(), F.lit(EXISTS))
                    .when(F.col("_found").isNull(), F.lit(unknown))
                    .otherwise(good))
        return (first.join(F.broadcast(seen.withColumn("_exists", F.lit(True))), key, "left")
                     .join(F.broadcast(found.withColumn("_found", F.lit(True))), "_ref", "left")
                     .withColumn(VERDICT, verdict).select(*first.columns, VERDICT))
    # Shuffled semi / anti joins straight against the big tables: they
    # need no distinct (duplicates on the right do not multiply rows),
    # and with both children plain shuffles AQE can split a hot
    # reference value on the left side.
    exists = first.join(known, key, "left_semi").withColumn(VERDICT, F.lit(EXISTS))
    fresh = first.join(known, key, "left_anti")
    if small_reference and row_count_at_most(ref_all, LOOKUP_MAX_ROWS):
        ref_all = F.broadcast(ref_all)
    ok = fresh.join(ref_all, "_ref", "left_semi").withColumn(VERDICT, good)
    missing = fresh.join(ref_all, "_ref", "left_anti").withColumn(VERDICT, F.lit(unknown))
    return exists.unionByName(ok).unionByName(missing)


def admit_landed(batch: DataFrame, *, key: str, landed: str,
                 existing: DataFrame | Callable[[DataFrame, int], DataFrame], existing_key: str,
                 ref_col: str, reference: DataFrame, reference_key: str, unknown: str,
                 small_reference: bool = False, money_col: str | None = None,
                 probe_max_rows: int | None = None, scratch: str | None = None) -> DataFrame:
    """Verdicts of landed files as if they came one by one.

    ``landed`` is the struct (time, file, row) a row came from.  Files count
    in the order (time, file).  ``duplicate_in_batch`` is judged inside one
    file; across files a key is ``already_exists`` only once an earlier
    file's row was accepted.  So it does not matter which files are handed
    over together.  A price (``money_col``) that is no price is
    ``bad_value``, the last check ahead of ``accepted``, as for a batch.

    Files are known by their number in that order: the list of a batch's
    files is small, so paths are neither shuffled nor sorted with the rows.
    The first row per (file, key) is found in two steps, so that a hot key
    spreads over ``SPREAD`` tasks first.  The window over a key then holds one
    row a file, however many rows of the key a file has.  The number of
    tasks follows the number of rows (``PART_ROWS`` each), so what a task
    holds does not grow with the batch.
    """
    fits = is_price(money_col) if money_col else F.lit(True)
    source = [F.col(f"{landed}.{c}") for c in ("time", "file")]
    files_of = materialise(batch.groupBy(*(c.alias(f"_{n}") for c, n in zip(source, ("time", "file"))))
                           .agg(F.count(F.lit(1)).alias("_n"))
                           .withColumn("_f", F.row_number().over(Window.orderBy("_time", "_file"))), "files", scratch)
    n_parts = -(-(files_of.agg(F.sum("_n")).first()[0] or 0) // PART_ROWS)

    def dealt(df: DataFrame, *by: str) -> DataFrame:
        """By ``by`` in tasks of about PART_ROWS; a small batch is left to AQE."""
        return df.repartition(n_parts, *by) if n_parts > SMALL_PARTS else df
    names = F.broadcast(files_of.drop("_n"))
    placed = (batch.withColumn("_time", source[0]).withColumn("_file", source[1]).withColumn("_row", F.col(f"{landed}.row"))
              .drop(landed).join(names, ["_time", "_file"]).drop("_time", "_file"))
    steps = (placed.filter(F.col(key).isNotNull())
             .select(key, "_f", "_row", F.col(ref_col).alias("_ref"), fits.alias("_fits"),
                     F.pmod(F.xxhash64("_row"), F.lit(SPREAD)).alias("_salt")))
    for by in ([key, "_f", "_salt"], [key, "_f"]):
        steps = (dealt(steps, *by).groupBy(*by)
                 .agg(F.min("_row").alias("_first"), F.min_by("_ref", "_row").alias("_ref"), F.min_by("_fits", "_row").alias("_fits"))
                 .withColumnRenamed("_first", "_row"))
    first = materialise(steps, "first-rows", scratch)
    alone = judge(first, key=key, existing=existing, existing_key=existing_key, ref_col=ref_col,
                  reference=reference, reference_key=reference_key, unknown=unknown,
                  small_reference=small_reference, probe_max_rows=probe_max_rows)
    won = F.min(F.when(F.col(VERDICT) == ACCEPTED, F.col("_f"))).over(Window.partitionBy(key))
    decided = (dealt(alone, key).withColumn("_won", won)
               .select(key, "_f", "_row", F.when(F.col("_won") < F.col("_f"), F.lit(EXISTS))
                       .otherwise(F.col(VERDICT)).alias(VERDICT)))
    # null keys match nothing; (key, file, row) is unique, so they spread as well
    at = [key, "_f", "_row"]
    judged = (dealt(placed, *at).join(dealt(decided, *at), at, "left")
              .withColumn(VERDICT, F.when(F.col(key).isNull(), F.lit(NULL_KEY))
                          .otherwise(F.coalesce(F.col(VERDICT), F.lit(DUPLICATE)))))
    return (judged.join(names, "_f")
            .withColumn(landed, F.struct(F.col("_time").alias("time"), F.col("_file").alias("file"), F.col("_row").alias("row")))
            .select(*batch.columns, VERDICT))


def add_customers(existing: DataFrame, batch: DataFrame, nation: DataFrame,
                  seq: str = "seq", check_seq: bool = True, scratch: str | None = None) -> DataFrame:
    """O4: verdicts for incoming customers (reference: nation)."""
    return admit(batch, key="c_custkey", seq=seq, existing=existing, existing_key="c_custkey",
                 ref_col="c_nationkey", reference=nation, reference_key="n_nationkey",
                 unknown="unknown_nation", small_reference=True, check_seq=check_seq, scratch=scratch)


def accept_orders(existing: DataFrame, batch: DataFrame, customer: DataFrame,
                  seq: str = "seq", check_seq: bool = True, scratch: str | None = None) -> DataFrame:
    """O6: verdicts for incoming orders (reference: customer, not broadcast:
    it grows with the data)."""
    return admit(batch, key="o_orderkey", seq=seq, existing=existing, existing_key="o_orderkey",
                 ref_col="o_custkey", reference=customer, reference_key="c_custkey",
                 unknown="unknown_customer", money_col="o_totalprice", check_seq=check_seq, scratch=scratch)


def accepted_rows(verdicts: DataFrame) -> DataFrame:
    """Accepted rows without the verdict column."""
    return verdicts.filter(F.col(VERDICT) == ACCEPTED).drop(VERDICT)


def customers_after_add(existing: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Existing customers UNION ALL the accepted ones."""
    return existing.unionByName(accepted_rows(verdicts).select(*existing.columns))


def store(verdicts: DataFrame, existing: DataFrame, out_path: str) -> DataFrame:
    """Write ``out_path/table`` (existing and accepted rows) and
    ``out_path/rejected`` (the other rows with their verdict), a new folder.
    Both are written beside it and appear with one rename, so a failure leaves
    no ``out_path`` and the call may be repeated.  Returns the written table.
    (``plans.storing`` keeps a table that grows call by call.)"""
    spark, draft = existing.sparkSession, f"{out_path.rstrip('/')}-draft-{uuid.uuid4().hex}"
    if files.exists(spark, out_path):
        raise ValueError(f"refusing to overwrite {out_path}: write the new version to a new directory")
    verdicts.filter(F.col(VERDICT) != ACCEPTED).write.parquet(f"{draft}/rejected")
    customers_after_add(existing, verdicts).write.parquet(f"{draft}/table")
    if not files.rename_new(spark, draft, out_path):
        files.remove(spark, draft)
        raise ValueError(f"refusing to overwrite {out_path}: another writer made it")
    return spark.read.schema(existing.schema).parquet(f"{out_path}/table")
