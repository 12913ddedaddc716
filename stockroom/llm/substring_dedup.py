"""Operator 7: repeated 50-word windows with a count-min prefilter.

Method.
1. *Sketch.*  Every window is counted under a key that equal windows share:
   the smallest hash among its 8-word shingles.  Neighbouring windows mostly
   have the same key, so a run of them is one increment (about one in 22
   windows).  Each task fills its own count-min sketch (``ROWS`` rows of
   counters that stop at two) and emits it in blocks; blocks are added up
   by Spark.  Counts are never too low, so a window that occurs in two
   documents always has an estimate of two or more.
2. *Exact pass.*  Only windows whose estimate is two or more are kept, with
   a 96-bit hash; documents with equal word sequences are one class and only
   their smallest ids go on.  A grouping by that hash gives each window's
   smallest document; a join back gives the windows that start in a smaller
   document too.

The sketch has ``CELLS_PER_KEY`` cells for each expected key, at most
``2**MAX_LOG2`` cells, so what is broadcast (one bit a cell) is at most
64 MB.  A fuller sketch only lets more windows through to the exact pass,
which is an ordinary shuffle; no window is lost at any size.

The joins that move windows and texts are always sort-merge joins, so the
plan is alike at every size.

Defined cases.  Null texts count as empty; a text with fewer than 50 words
has no window.  A row with a null ``doc_id`` neither removes nor loses words.
Rows with equal ``doc_id`` don't remove each other's words (only a *smaller*
id does).  Hot passages are combined inside each task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import (RW1, RW2, U, discard, mix64, seeds, signed, stash, stash_at, text_column,
                                   unused, window_hashes, word_groups)

WINDOW = 50            # words
KEY_SHINGLE = 8        # words of the shingles a window is counted under
ROWS = 2               # rows of the count-min sketch
CELLS_PER_KEY = 16
MIN_LOG2, MAX_LOG2 = 20, 29
BLOCK = 1 << 19        # cells in an emitted block
BYTES_PER_KEY = 130    # of text, for the size of the sketch only

CANDIDATES = T.StructType([
    T.StructField("rid", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("th", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("c1", T.LongType()), T.StructField("c2", T.LongType()),
    T.StructField("h1", T.ArrayType(T.LongType(), False)),
    T.StructField("h2", T.ArrayType(T.IntegerType(), False)),
    T.StructField("pos", T.ArrayType(T.IntegerType(), False)),
])


def _sliding_min(s: np.ndarray, width: int) -> np.ndarray:
    """min(s[i:i+width]) for every i."""
    m, done = s, 1
    while done < width:
        step = min(done, width - done)
        m = np.minimum(m[:len(m) - step], m[step:])
        done += step
    return m


def window_keys(h: np.ndarray) -> np.ndarray:
    """Key of the window from each word on; len(h) - WINDOW + 1 of them."""
    if len(h) < WINDOW:
        return np.zeros(0, U)
    return _sliding_min(window_hashes(h, KEY_SHINGLE, RW1), WINDOW - KEY_SHINGLE + 1)


def _inside(first: np.ndarray, n_windows: int) -> np.ndarray:
    """Which of the windows of a group of documents lie in one document."""
    ok = np.zeros(max(n_windows, 0) + 1, np.int64)
    a, b = first[:-1], first[1:] - WINDOW + 1
    a, b = a[b > a], b[b > a]
    np.add.at(ok, a, 1)
    np.add.at(ok, b, -1)
    return ok[:-1].cumsum() > 0


def _cells(keys: np.ndarray, log2: int) -> list[np.ndarray]:
    """The cell of each key in each row; the rows lie one after another."""
    width = log2 - (ROWS.bit_length() - 1)
    return [(mix64(keys ^ s) >> U(64 - width)).astype(np.int64) + (r << width)
            for r, s in enumerate(seeds(ROWS, 21))]


def _add(one: np.ndarray, two: np.ndarray, cell: np.ndarray) -> None:
    """Count cells; bit sets of the cells counted once and twice or more."""
    if not len(cell):
        return
    cell = np.sort(cell)
    again = np.append(False, cell[1:] == cell[:-1])
    bit = (128 >> (cell & 7)).astype(np.uint8)
    at = cell >> 3
    first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    byte = at[first]
    new = np.bitwise_or.reduceat(bit, first)
    twice = np.bitwise_or.reduceat(np.where(again, bit, 0).astype(np.uint8), first)
    two[byte] |= twice | (one[byte] & new)
    one[byte] |= new


def _sketch(log2: int):
    """Task: the task's sketch, as blocks of saturated counts, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = (np.zeros(1 << (log2 - 3), np.uint8) for _ in range(2))
        for batch in batches:
            for _, _, w in word_groups(batch, "text", lower=False):
                keys = window_keys(w.h)
                ok = _inside(w.first, len(keys))
                fresh = ok.copy()
                fresh[1:] &= (keys[1:] != keys[:-1]) | ~ok[:-1]
                starts = w.first[:-1]
                starts = starts[starts < len(keys)]
                fresh[starts] = ok[starts]
                keys = keys[fresh]
                for cell in _cells(keys, log2):
                    _add(one, two, cell)
        step = BLOCK >> 3
        for b in range(0, len(one), step):
            if one[b:b + step].any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b // step], pa.int32()), pa.array([one[b:b + step].tobytes()], pa.binary()),
                     pa.array([two[b:b + step].tobytes()], pa.binary())], names=["block", "one", "two"])
    return run


def _merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group: adds up the blocks of one place, one Arrow batch at a time."""
    one = two = None
    for batch in batches:
        for o, t in zip(batch.column("one"), batch.column("two")):
            o, t = (np.frombuffer(x.as_buffer(), np.uint8) for x in (o, t))
            if one is None:
                one, two = o.copy(), t.copy()
            else:
                two |= t | (one & o)
                one |= o
    if one is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()),
             pa.array([one.tobytes()], pa.binary()), pa.array([two.tobytes()], pa.binary())],
            names=["block", "one", "two"])


def repeated_cells(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(log2 of the cells, bitmap of the cells counted twice or more)."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    need = CELLS_PER_KEY * size / BYTES_PER_KEY
    log2 = min(MAX_LOG2, max(MIN_LOG2, int(np.ceil(np.log2(max(2, need))))))
    blocks = "block int, one binary, two binary"
    parts = texts.select("text").mapInArrow(_sketch(log2), blocks)
    # two steps, so that no task gets the blocks of all tasks
    parts = (parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
             .groupBy("block", "salt").applyInArrow(_merge, blocks)
             .groupBy("block").applyInArrow(_merge, blocks))
    bits = np.zeros(1 << (log2 - 3), np.uint8)
    for row in parts.select("block", "two").toLocalIterator():   # at most 64 MB in all
        at = row["block"] * (BLOCK >> 3)
        bits[at:at + len(row["two"])] = np.frombuffer(row["two"], np.uint8)
    return log2, bits


def _candidates(log2: int, shared):
    """Task: per document the windows whose estimate is two or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for d, e, w in word_groups(batch, "text", lower=False):
                keys = window_keys(w.h)
                hit = _inside(w.first, len(keys))
                fresh = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
                some = np.ones(len(fresh), bool)
                for cell in _cells(keys[fresh], log2):
                    some &= (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
                hit &= np.repeat(some, np.diff(np.append(fresh, len(keys))))
                at = np.flatnonzero(hit)
                if not len(at):
                    continue
                doc = np.searchsorted(w.first, at, "right") - 1
                n_hit = np.bincount(doc, minlength=e - d)
                own = np.flatnonzero(n_hit)
                g2 = w.hash(RW2)
                h1 = window_hashes(w.h, WINDOW, RW1)[at]
                h2 = (window_hashes(g2, WINDOW, RW2)[at] >> U(32)).astype(np.uint32).view(np.int32)
                lens = np.diff(w.first)[own]
                c1 = np.array([np.add.reduce(mix64(w.h[w.first[k]:w.first[k + 1]]
                                                   + np.arange(w.first[k + 1] - w.first[k]).astype(U) * U(RW1)))
                               for k in own], U)
                c2 = np.array([np.add.reduce(mix64(g2[w.first[k]:w.first[k + 1]]
                                                   + np.arange(w.first[k + 1] - w.first[k]).astype(U) * U(RW2)))
                               for k in own], U)
                off = pa.array(np.append(0, n_hit[own].cumsum()).astype(np.int32))
                rows = batch.slice(d, e - d).take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pa.array(lens.astype(np.int64)),
                     pa.array(signed(c1)), pa.array(signed(c2)),
                     pa.ListArray.from_arrays(off, pa.array(signed(h1))),
                     pa.ListArray.from_arrays(off, pa.array(h2)),
                     pa.ListArray.from_arrays(off, pa.array((at - w.first[doc]).astype(np.int32)))],
                    names=CANDIDATES.fieldNames())
    return run


def _ranges(starts: list) -> list:
    """Word ranges covered by windows at these positions."""
    out = []
    for s in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1][1] = s + WINDOW
        else:
            out.append([s, s + WINDOW])
    return out


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, th, starts): for each row with words to remove, the positions
    of its windows that also start in a document with a smaller ``doc_id``.
    ``th`` is ``xxhash64(text)``.  Of an exact copy only every 50th window is
    listed; they cover it."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
                .filter("doc_id is not null")
    log2, bits = repeated_cells(texts)
    shared = spark.sparkContext.broadcast(bits)
    found, at_found = stash_at(
        texts.select(F.monotonically_increasing_id().alias("rid"), "doc_id", F.xxhash64("text").alias("th"), "text")
        .mapInArrow(_candidates(log2, shared), CANDIDATES), "windows")
    same = ["c1", "c2", "n"]
    classes = stash(found.groupBy(*same).agg(F.min("doc_id").alias("least")), "classes")
    marked = stash(found.select("rid", "doc_id", "th", *same).join(classes.hint("merge"), same)
                   .select("rid", "doc_id", "th", "n", (F.col("doc_id") > F.col("least")).alias("copy")), "marked")
    copies = marked.filter("copy").select(
        "doc_id", "th", F.expr(f"transform(sequence(0, (n - 1) div {WINDOW}), "
                               f"i -> cast(least(i * {WINDOW}, n - {WINDOW}) as int))").alias("starts"))
    wins = stash(found.select("rid", "doc_id", "h1", "h2", "pos")
                 .join(marked.filter("not copy").select("rid").hint("merge"), "rid", "left_semi")
                 .select("rid", "doc_id", F.explode(F.arrays_zip("h1", "h2", "pos")).alias("w"))
                 .select("rid", "doc_id", "w.h1", "w.h2", "w.pos"), "wins")
    discard(spark, at_found)
    least = stash(wins.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                  .filter("lo < hi").select("h1", "h2", "lo"), "least")
    mine = (wins.join(least.hint("merge"), ["h1", "h2"]).filter("doc_id > lo")
            .groupBy("rid").agg(F.collect_list("pos").alias("starts")))   # at most a document's windows
    mine = marked.select("rid", "doc_id", "th").join(mine, "rid").select("doc_id", "th", "starts")
    return mine.unionByName(copies).groupBy("doc_id", "th").agg(F.first("starts").alias("starts"))


def _remove(schema: T.StructType, at_text: int, at_starts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = text_column(batch, "text")
            raw = data.tobytes()
            starts = batch.column(at_starts)
            had, lost, kept = [], [], []
            for i in range(batch.num_rows):
                words = raw[off[i]:off[i + 1]].split()
                had.append(len(words))
                cut = starts[i].as_py()
                n = 0
                for a, b in reversed(_ranges(cut or [])):
                    n += b - a
                    del words[a:b]
                lost.append(n)
                kept.append(b" ".join(words).decode())
            cols = [c for k, c in enumerate(batch.columns) if k != at_starts]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(had, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.large_string()).cast(pa.string())],
                names=[f.name for f in schema.fields])
    return run


def remove_repeats(docs: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Columns ``only`` of ``docs`` (all by default) with ``n_words``,
    ``n_removed`` and ``kept_text`` (kept words joined by one space).  A
    column of ``docs`` with one of these names is replaced."""
    cols = [c for c in (only or docs.columns) if c not in ("n_words", "n_removed", "kept_text")]
    base = docs.select(*[F.col(c) for c in dict.fromkeys([*cols, "doc_id", "text"])])
    own, th, starts = (unused(n, docs.columns) for n in ("id_of_starts", "th_of_starts", "starts"))
    cuts = repeated_windows(docs).select(F.col("doc_id").alias(own), F.col("th").alias(th),
                                         F.col("starts").alias(starts)).hint("merge")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = (base.join(cuts, (F.col("doc_id").cast("long") == F.col(own)) & (F.xxhash64(text) == F.col(th)), "left")
              .drop(own, th))
    names = joined.columns
    out = T.StructType([f for f in joined.schema.fields if f.name != starts]
                       + [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                          T.StructField("kept_text", T.StringType())])
    return joined.mapInArrow(_remove(out, names.index("text"), names.index(starts)), out)
