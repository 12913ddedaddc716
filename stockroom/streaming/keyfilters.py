"""Bloom filters of key files: which of them can hold a key of a batch.

A key segment is cut by key range into parts, one folder each.  Statistics of
a part prune keys that grow over time; random keys fall into every part.  So
each part also has a filter (``BITS`` bits a key, ``HASHES`` of them set) in a
table of its own, a tenth of the keys in size.  A batch's keys are held
against the filters where those lie, and only parts that may hold one are opened.  A
filter never misses a key that is there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 16
HASHES = 8
PART_KEYS = 2_000_000
PROBE_KEYS = 500_000   # keys of a batch that are sent to the filters

FILTERS = "part int, lo long, hi long, n long, bits binary"


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """(keys, HASHES) bit positions, from the two halves of a 64-bit hash."""
    h = h.astype(np.uint64)
    a, b = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return (a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) % np.uint64(bits)


def make_filter(h: np.ndarray) -> bytes:
    bits = max(64, len(h) * BITS)
    mask = np.zeros(bits, bool)
    mask[places(h, bits).ravel()] = True
    return np.packbits(mask).tobytes()


def may_hold(raw: bytes, n: int, h: np.ndarray) -> np.ndarray:
    at = places(h, max(64, n * BITS))
    byte = np.frombuffer(raw, np.uint8)[at >> np.uint64(3)]
    return ((byte >> (7 - (at & np.uint64(7)).astype(np.uint8))) & 1).all(1)


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def row(part: int) -> pa.RecordBatch:
        keys = np.concatenate([k for k, _ in held[part]])
        h = np.concatenate([x for _, x in held.pop(part)])
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([keys.min()], pa.int64()), pa.array([keys.max()], pa.int64()),
             pa.array([len(keys)], pa.int64()), pa.array([make_filter(h)], pa.binary())], names=["part", "lo", "hi", "n", "bits"])
    for batch in batches:
        part, key, h = (batch.column(i).to_numpy() for i in range(3))
        for p in np.unique(part):
            at = part == p
            held.setdefault(int(p), []).append((key[at], h[at]))
            if sum(len(k) for k, _ in held[int(p)]) >= PART_KEYS:   # a second row of the part then
                yield row(int(p))
    for p in list(held):
        yield row(p)


def write_parts(keys: DataFrame, key: str, path: str, part_keys: int = PART_KEYS) -> None:
    """Write ``path/keys/part=<i>`` and ``path/filters``."""
    n = keys.count()
    parts = max(1, -(-n // part_keys))
    (keys.select(key).repartitionByRange(parts, key).withColumn("part", F.spark_partition_id())
         .sortWithinPartitions("part", key).write.partitionBy("part").parquet(f"{path}/keys"))
    if n:
        stored = keys.sparkSession.read.parquet(f"{path}/keys")
        (stored.select(F.col("part").cast("int"), F.col(key).cast("long"), F.xxhash64(key)).mapInArrow(_filters, FILTERS)
               .write.parquet(f"{path}/filters"))
    else:
        keys.sparkSession.createDataFrame([], FILTERS).write.parquet(f"{path}/filters")


def parts_with(paths: list[str], keys: DataFrame, key: str) -> tuple[list[str], int]:
    """(folders of the parts that may hold one of ``keys``, all parts), over
    the segments at ``paths``.  ``keys`` are few (``PROBE_KEYS``)."""
    spark = keys.sparkSession
    probe = keys.select(F.col(key).cast("long").alias("k"), F.xxhash64(key).alias("h")).distinct().toArrow()
    k, h = probe["k"].to_numpy(), probe["h"].to_numpy()
    order = np.argsort(k)
    shared = spark.sparkContext.broadcast((k[order], h[order]))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, h = shared.value
        for batch in batches:
            at, part = [], []
            for seg, p, lo, hi, n, bits in zip(*(batch.column(i).to_pylist() for i in range(6))):
                a, b = np.searchsorted(k, lo, "left"), np.searchsorted(k, hi, "right")
                if a < b and may_hold(bits, n, h[a:b]).any():
                    at.append(seg)
                    part.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(part, pa.int32())], names=["seg", "part"])
    filters = None
    for i, path in enumerate(paths):
        one = spark.read.schema(FILTERS).parquet(f"{path}/filters").select(F.lit(i).cast("int").alias("seg"), "part", "lo", "hi", "n", "bits")
        filters = one if filters is None else filters.unionByName(one)
    if filters is None:
        return [], 0
    total = filters.select("seg", "part").distinct().count()
    found = filters.mapInArrow(hits, "seg int, part int").distinct().collect() if len(k) else []
    return [f"{paths[r['seg']]}/keys/part={r['part']}" for r in sorted(found)], total
