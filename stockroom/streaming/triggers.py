"""O10, O11, O12: insert triggers on newly landed files.

A database trigger fires inside the inserting transaction.  Here the
"insert" is a file landing in ``in_dir`` and the trigger is a Structured
Streaming query with ``foreachBatch``.  For micro-batch ``N``:

* O10 (before insert, validate): every landed row gets a verdict as if the
  files came one by one, in the order (modification time, path): repeated
  keys are judged inside a file, and against rows accepted from earlier
  files, the base table and batches ``< N``.  How a backlog is cut into
  micro-batches thus decides nothing (files of one millisecond excepted:
  Spark does not say which of them it takes first).  All rows are written once to
  ``out_dir/rows/batch_id=N/verdict=<v>/``: accepted and rejected rows land
  apart, and ``verdict=accepted`` is the new data of the table.
* O11 (after insert, audit): ``out_dir/audit/batch_id=N`` gets one row per
  landed row: key, verdict, batch id and where the row came from.
* O12 (after insert, kept totals): ``out_dir/totals/batch_id=N`` gets the
  per-customer partial aggregate of the rows accepted in batch N;
  ``kept_totals`` re-aggregates the partials.

Folding: batches leave small folders.  Every ``compact_every`` committed
batches a thread beside the stream folds what they wrote (keys, totals,
audit log, rows) into segments that grow level by level
(``streaming.segments``); the folders of folded batches go a round later.  Key segments carry
filters, so that a batch opens only the key files that may hold its keys
(``streaming.keyfilters``).

Replay safety: a crash after the writes and before the stream commits
makes Spark run batch N again.  Each output is overwritten per batch id,
and the key check reads accepted rows of earlier batches only, so a replay
neither finds its own rows (and rejects them) nor doubles them.  The batch
number belongs to the checkpoint, so a new checkpoint over an output that
already holds batches is refused.  One writer per output directory.  Readers see committed
batches only, as far as the checkpoint tells.

``reference`` and ``base`` may be a path, a table name or a function that
returns a frame: then each micro-batch opens them anew and sees rows that
came since.  A frame given as such stays as it was.
"""

from __future__ import annotations

import threading
import warnings
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stockroom.operators.admission import ACCEPTED, VERDICT, admit_landed
from stockroom.operators.totals import merge_totals, order_totals_partial
from stockroom.schemas import CUSTOMER, ORDERS
from stockroom.session import scratch_dir
from stockroom import files
from stockroom.streaming import keyfilters
from stockroom.streaming.segments import FULL_BYTES, Segments

LANDED = "landed"   # struct(time, file, row): where a row came from; also its insertion order
COMPACT_EVERY = 20  # committed batches between two rounds of folding
PACK_BYTES = 128 << 20   # files of folded rows and audit logs
KEYS, TOTALS, AUDIT, ROWS = "keys", "totals", "audit", "rows"

Source = DataFrame | str | Callable[[], DataFrame]


@dataclass(frozen=True)
class InsertRules:
    """What a trigger checks for one table."""
    table: str
    schema: T.StructType
    key: str
    ref_col: str
    reference_key: str
    unknown: str
    small_reference: bool = False
    keeps_totals: bool = False
    money_col: str | None = None


ORDER_RULES = InsertRules("orders", ORDERS, "o_orderkey", "o_custkey", "c_custkey",
                          "unknown_customer", small_reference=False, keeps_totals=True, money_col="o_totalprice")
CUSTOMER_RULES = InsertRules("customer", CUSTOMER, "c_custkey", "c_nationkey", "n_nationkey",
                             "unknown_nation", small_reference=True)


def _rows_path(out_dir: str) -> str:
    return f"{out_dir}/rows"


def _row_schema(rules: InsertRules) -> T.StructType:
    landed = T.StructType([T.StructField("time", T.TimestampType()), T.StructField("file", T.StringType()),
                           T.StructField("row", T.LongType())])
    return T.StructType(list(rules.schema.fields) + [T.StructField(LANDED, landed)])


def open_source(spark: SparkSession, source: Source) -> DataFrame:
    """The frame of a path, a table name or a function, opened now."""
    if isinstance(source, str):
        return spark.read.parquet(source) if "/" in source else spark.table(source)
    return source() if callable(source) else source


def segments_of(spark: SparkSession, out_dir: str, what: str) -> Segments:
    # a key segment takes part in every probe, so no size ends its folding
    return Segments(spark, f"{out_dir}/segments/{what}", full_bytes=FULL_BYTES if what in (AUDIT, ROWS) else 1 << 62)


def _batch_dirs(spark: SparkSession, out_dir: str, what: str, after: int, upto: int, below: str = "") -> list[str]:
    """Folders of the batches ``after < batch_id <= upto`` that exist; only
    they are looked at."""
    return [d for i in range(after + 1, upto + 1)
            if files.exists(spark, d := f"{out_dir}/{what}/batch_id={i}{below}")]


def _stored_schema(rules: InsertRules) -> T.StructType:
    return T.StructType(list(_row_schema(rules).fields)
                        + [T.StructField("batch_id", T.LongType()), T.StructField(VERDICT, T.StringType())])


def _read_rows(spark: SparkSession, out_dir: str, rules: InsertRules, segments: list[dict], after: int, upto: int,
               accepted: bool) -> DataFrame:
    """Rows of segments and of the batches behind them."""
    schema = _stored_schema(rules)
    below = f"/{VERDICT}={ACCEPTED}" if accepted else ""
    part = spark.createDataFrame([], schema)
    if dirs := _batch_dirs(spark, out_dir, ROWS, after, upto, below):
        part = spark.read.schema(schema).option("basePath", _rows_path(out_dir)).parquet(*dirs)
    got = [part.select(*schema.fieldNames())]
    for s in segments:
        path = segments_of(spark, out_dir, ROWS).path(s)
        if not below or files.exists(spark, path + below):
            got.append(spark.read.schema(schema).option("basePath", path).parquet(path + below).select(*schema.fieldNames()))
    out = got[0]
    for g in got[1:]:
        out = out.unionByName(g)
    return out


def _committed(spark: SparkSession, out_dir: str, checkpoint: str | None) -> int:
    """Highest committed batch, -1 if there is none."""
    n = committed_batch(spark, checkpoint or f"{out_dir.rstrip('/')}/_checkpoint")
    return -1 if n is None else n


def _all_rows(spark: SparkSession, out_dir: str, rules: InsertRules, checkpoint: str | None, accepted: bool) -> DataFrame:
    upto, segments = segments_of(spark, out_dir, ROWS).current()
    return _read_rows(spark, out_dir, rules, segments, upto, _committed(spark, out_dir, checkpoint), accepted)


def accepted_rows(spark: SparkSession, out_dir: str, rules: InsertRules = ORDER_RULES,
                  checkpoint: str | None = None) -> DataFrame:
    """The rows the trigger let in, with the batch that accepted them."""
    return _all_rows(spark, out_dir, rules, checkpoint, True).select(*[f.name for f in rules.schema.fields], "batch_id")


def rejected_rows(spark: SparkSession, out_dir: str, rules: InsertRules = ORDER_RULES,
                  checkpoint: str | None = None) -> DataFrame:
    """The rows the trigger refused, with the reason and the batch."""
    return (_all_rows(spark, out_dir, rules, checkpoint, False).filter(F.col(VERDICT) != ACCEPTED)
            .select(*[f.name for f in rules.schema.fields], "batch_id", VERDICT))


AUDIT_SCHEMA = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField(VERDICT, T.StringType()),
    T.StructField("landed_file", T.StringType()),
    T.StructField("landed_row", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


def _read_audit(spark: SparkSession, out_dir: str, segments: list[dict], after: int, upto: int) -> DataFrame:
    """The log of segments and of the batches behind them."""
    at = segments_of(spark, out_dir, AUDIT)
    paths = [at.path(s) for s in segments] + _batch_dirs(spark, out_dir, AUDIT, after, upto)
    return spark.read.schema(AUDIT_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], AUDIT_SCHEMA)


def audit_log(spark: SparkSession, out_dir: str, checkpoint: str | None = None) -> DataFrame:
    upto, segments = segments_of(spark, out_dir, AUDIT).current()
    return _read_audit(spark, out_dir, segments, upto, _committed(spark, out_dir, checkpoint))


TOTALS_SCHEMA = T.StructType([
    T.StructField("o_custkey", T.LongType()),
    T.StructField("n_orders", T.LongType()),
    T.StructField("total_price", T.DecimalType(38, 2)),
    T.StructField("last_order_date", T.TimestampNTZType()),
    T.StructField("n_unfit", T.LongType()),
])


def _read_totals(spark: SparkSession, out_dir: str, segments: list[dict], after: int, upto: int) -> DataFrame:
    """Partials of segments and of the batches behind them."""
    at = segments_of(spark, out_dir, TOTALS)
    paths = [at.path(s) for s in segments] + _batch_dirs(spark, out_dir, TOTALS, after, upto)
    return spark.read.schema(TOTALS_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], TOTALS_SCHEMA)


def kept_totals(spark: SparkSession, out_dir: str, checkpoint: str | None = None) -> DataFrame:
    """O12 view: current per-customer totals, the segments merged with the
    partials of the committed batches behind them."""
    upto, segments = segments_of(spark, out_dir, TOTALS).current()
    return merge_totals(_read_totals(spark, out_dir, segments, upto, _committed(spark, out_dir, checkpoint)))


def committed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """Highest batch id the stream has committed (from the checkpoint's
    commit log); batches above it may still be replayed."""
    ids = [int(n) for n in files.child_names(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(ids) if ids else None


class InsertTrigger:
    """Validate-audit-total trigger for files landing in ``in_dir``.

    ``base`` is the table as it was before the trigger started (may be
    None), ``reference`` the table the reference column must point into
    (customers for orders, nations for customers); see the module doc for
    what they may be.  ``max_files_per_trigger`` bounds a micro-batch (None:
    everything new at once); every ``compact_every`` committed batches a thread
    beside the stream folds them (None: only by ``compact``).
    """

    def __init__(self, spark: SparkSession, in_dir: str, out_dir: str, rules: InsertRules,
                 reference: Source, base: Source | None = None,
                 checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                 compact_every: int | None = COMPACT_EVERY):
        self.spark = spark
        self.in_dir = in_dir.rstrip("/")
        self.out_dir = out_dir.rstrip("/")
        self.rules = rules
        self.reference = reference
        self.base = base
        self.checkpoint = checkpoint or f"{self.out_dir}/_checkpoint"
        self.max_files = max_files_per_trigger
        self.compact_every = compact_every
        self.folding: threading.Thread | None = None
        self.opened: dict[int, tuple[int, int]] = {}    # by batch: key parts that were opened, and all

    # -- the stream --------------------------------------------------------
    def source(self) -> DataFrame:
        r = (self.spark.readStream.schema(self.rules.schema)
             .option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet"))
        if self.max_files:
            r = r.option("maxFilesPerTrigger", str(self.max_files))
        df = r.parquet(self.in_dir)
        return df.select(*[F.col(f.name) for f in self.rules.schema.fields],
                         F.struct(F.col("_metadata.file_modification_time").alias("time"),
                                  F.col("_metadata.file_path").alias("file"),
                                  F.col("_metadata.row_index").alias("row")).alias(LANDED))

    def _check_checkpoint(self) -> None:
        # New means no batch was ever planned.  A checkpoint with planned but
        # uncommitted batches is a restart: Spark replays them, which is safe.
        fresh = not files.child_names(self.spark, f"{self.checkpoint}/offsets")
        done = [n for n in files.child_names(self.spark, _rows_path(self.out_dir))
                if n.startswith("batch_id=")]
        if fresh and done:
            raise RuntimeError(
                f"{self.out_dir} already holds {len(done)} batch(es) but checkpoint "
                f"{self.checkpoint} is new; batch numbers would restart at 0 and overwrite them")

    def start(self, available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
        self._check_checkpoint()
        w = (self.source().writeStream
             .foreachBatch(self.handle)
             .option("checkpointLocation", self.checkpoint)
             .queryName(f"insert_trigger_{self.rules.table}_{zlib.crc32(self.out_dir.encode()):08x}"))
        if available_now:
            w = w.trigger(availableNow=True)
        elif processing_time:
            w = w.trigger(processingTime=processing_time)
        return w.start()

    def run_available(self) -> None:
        """Process every landed file not yet seen, then return."""
        q = self.start(available_now=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        if self.folding is not None:
            self.folding.join()

    # -- one micro-batch ---------------------------------------------------
    def existing_keys(self, batch_id: int, first: DataFrame | None = None, n: int = 0) -> DataFrame:
        """Base table keys plus keys accepted by earlier batches only: of the
        key segments the parts that may hold one of ``first`` (``n`` keys; all
        parts without it), and the rows of the batches behind the segments."""
        key = self.rules.key
        at = segments_of(self.spark, self.out_dir, KEYS)
        upto, segments = at.current()
        if upto >= batch_id:                 # an old batch again, by hand: only what was before it
            segments = [s for s in segments if s["hi"] < batch_id]
            upto = max([-1, *(s["hi"] for s in segments)])
        keys = _read_rows(self.spark, self.out_dir, self.rules, [], upto, batch_id - 1, True).select(key)
        paths = [at.path(s) for s in segments]
        if paths and first is not None and n <= keyfilters.PROBE_KEYS:
            paths, total = keyfilters.parts_with(paths, first, key)
            self.opened[batch_id] = (len(paths), total)
        else:
            paths = [f"{p}/keys" for p in paths]
        if paths:
            schema = T.StructType([self.rules.schema[key]])
            keys = keys.unionByName(self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths))
        if self.base is not None:
            keys = open_source(self.spark, self.base).select(key).unionByName(keys)
        return keys

    def compact(self) -> int | None:
        """Fold the committed batches (see ``streaming.segments``): accepted
        keys with their filters, merged totals, the audit log and the rows.  Each becomes visible
        by a manifest of its own, so this may run beside the stream and may
        fail anywhere.  Returns the last folded batch."""
        n = committed_batch(self.spark, self.checkpoint)
        if n is None:
            return None
        spark, out, key = self.spark, self.out_dir, self.rules.key

        def keys(segments: list[dict], after: int, path: str) -> None:
            rows = _read_rows(spark, out, self.rules, [], after, n, True).select(key)
            for s in segments:
                rows = rows.unionByName(spark.read.schema(T.StructType([self.rules.schema[key]]))
                                        .parquet(f"{segments_of(spark, out, KEYS).path(s)}/keys").select(key))
            keyfilters.write_parts(rows, key, path)

        def totals(segments: list[dict], after: int, path: str) -> None:
            merge_totals(_read_totals(spark, out, segments, after, n)).write.parquet(path)

        def packed(df: DataFrame, segments: list[dict], dirs: list[str], path: str, by: str | None = None) -> None:
            held = sum(s["bytes"] for s in segments) + sum(sum(files.sizes(spark, d).values()) for d in dirs)
            df = df.coalesce(max(1, -(-held // PACK_BYTES)))
            (df.write.partitionBy(by) if by else df.write).parquet(path)

        def audit(segments: list[dict], after: int, path: str) -> None:
            packed(_read_audit(spark, out, segments, after, n), segments, _batch_dirs(spark, out, AUDIT, after, n), path)

        def rows(segments: list[dict], after: int, path: str) -> None:
            packed(_read_rows(spark, out, self.rules, segments, after, n, False), segments,
                   _batch_dirs(spark, out, ROWS, after, n), path, VERDICT)
        segments_of(spark, out, KEYS).round(n, keys)
        if self.rules.keeps_totals:
            segments_of(spark, out, TOTALS).round(n, totals)
        segments_of(spark, out, AUDIT).round(n, audit)
        segments_of(spark, out, ROWS).round(n, rows)
        # key segments read the rows of batches, so those stay until both have them
        for what, needed in ((TOTALS, [TOTALS]), (AUDIT, [AUDIT]), (ROWS, [ROWS, KEYS])):
            settled = min(segments_of(spark, out, w).settled() for w in needed)
            for name in files.child_names(spark, f"{out}/{what}"):
                if name.startswith("batch_id=") and int(name[len("batch_id="):]) <= settled:
                    files.remove(spark, f"{out}/{what}/{name}")
        return n

    def _fold_beside(self) -> None:
        """Start a round in a thread of its own if one is due and none runs.
        A round that fails counts for nothing; the next one does its work."""
        if not self.compact_every or (self.folding is not None and self.folding.is_alive()):
            return
        upto = segments_of(self.spark, self.out_dir, KEYS).current()[0]
        if _committed(self.spark, self.out_dir, self.checkpoint) - upto < self.compact_every:
            return

        def run() -> None:
            try:
                self.compact()
            except Exception as e:
                warnings.warn(f"folding of {self.out_dir} failed and will be tried again: {e}", stacklevel=1)
        self.folding = threading.Thread(target=run, daemon=True, name=f"fold-{self.rules.table}")
        self.folding.start()

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        scratch = scratch_dir(self.spark, "trigger")
        try:
            self._handle(batch, batch_id, scratch)
        finally:
            files.remove(self.spark, scratch)
        self._fold_beside()

    def _handle(self, batch: DataFrame, batch_id: int, scratch: str) -> None:
        r = self.rules
        verdicts = admit_landed(batch, key=r.key, landed=LANDED,
                                existing=lambda first, n: self.existing_keys(batch_id, first, n), existing_key=r.key,
                                ref_col=r.ref_col, reference=open_source(self.spark, self.reference),
                                reference_key=r.reference_key, unknown=r.unknown,
                                small_reference=r.small_reference, money_col=r.money_col, scratch=scratch)
        rows_n = f"{_rows_path(self.out_dir)}/batch_id={batch_id}"
        # O10: one pass over the batch; accepted and rejected rows go to
        # their own verdict=... directories.
        verdicts.write.mode("overwrite").partitionBy(VERDICT).parquet(rows_n)

        # O11 and O12 read back what was written: cheap column reads, and
        # they describe exactly the committed rows.
        written = (self.spark.read
                   .schema(T.StructType(list(_row_schema(r).fields)
                                        + [T.StructField(VERDICT, T.StringType())]))
                   .option("basePath", rows_n).parquet(rows_n))
        audit = (written.select(F.col(r.key).cast("bigint").alias("key"), VERDICT,
                                F.col(f"{LANDED}.file").alias("landed_file"),
                                F.col(f"{LANDED}.row").alias("landed_row"))
                        .withColumn("batch_id", F.lit(batch_id).cast("bigint")))
        # One after the other, in the stream's own thread: ``stop`` then ends
        # both, and a failure retries the batch.
        audit.write.mode("overwrite").parquet(f"{self.out_dir}/audit/batch_id={batch_id}")
        if r.keeps_totals:
            partial = order_totals_partial(written.filter(F.col(VERDICT) == ACCEPTED))
            partial.write.mode("overwrite").parquet(f"{self.out_dir}/totals/batch_id={batch_id}")


def register_trigger_views(spark: SparkSession, out_dir: str, rules: InsertRules = ORDER_RULES,
                           prefix: str | None = None, checkpoint: str | None = None) -> None:
    """Temp views over a trigger's output for SQL users:
    ``<table>_accepted``, ``<table>_audit`` and, for orders,
    ``<table>_kept_totals``."""
    name = prefix or rules.table
    accepted_rows(spark, out_dir, rules, checkpoint).createOrReplaceTempView(f"{name}_accepted")
    audit_log(spark, out_dir, checkpoint).createOrReplaceTempView(f"{name}_audit")
    if rules.keeps_totals:
        kept_totals(spark, out_dir, checkpoint).createOrReplaceTempView(f"{name}_kept_totals")


def on_insert(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str | None = None,
              rules: InsertRules = ORDER_RULES, reference: Source | None = None,
              base: Source | None = None, available_now: bool = True) -> StreamingQuery:
    """O10-O12 in one call: start the insert trigger for files landing in
    ``in_dir``.  ``reference`` defaults to the session's registered table
    (``customer`` for orders, ``nation`` for customers)."""
    if reference is None:
        reference = "customer" if rules.table == "orders" else "nation"
    return InsertTrigger(spark, in_dir, out_dir, rules, reference=reference, base=base,
                         checkpoint=checkpoint).start(available_now=available_now)
