"""Vectorised text kernels that run inside tasks, and small Spark helpers.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``; in UTF-8 that is
the same as on code points.  All kernels work on whole texts; an Arrow batch
is cut into groups of documents of about ``CHUNK_BYTES`` (a longer document
is a group of its own), so memory follows the longest document.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stockroom.session import shared_dir

CHUNK_BYTES = 1 << 20
U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (the public SplitMix64 constants)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix64(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(salt))


def powers(r: int, n: int) -> np.ndarray:
    """r**0 .. r**(n-1) modulo 2**64."""
    out = np.full(n, r, U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


R1, R2 = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95   # salts of the word hashes
RW1, RW2 = 0xA0761D6478BD642F, 0xE7037ED1A0B428DB  # odd multipliers of the window hashes


@dataclass
class Words:
    """The words of a group of documents.

    ``first[d] .. first[d+1]`` are the words of document ``d``; ``start`` and
    ``end`` are byte positions in ``data``, ``h`` 64-bit hashes.
    """
    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    h: np.ndarray

    def hash(self, r: int) -> np.ndarray:
        """Each byte with its place in the word goes through the finaliser
        with the salt ``r``; a word's hash is the sum, finalised.  (A
        polynomial modulo 2**64 would give equal values for words that can be
        written down, whatever its base.)"""
        if not len(self.start):
            return np.zeros(0, U)
        size = self.end - self.start
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
        byte = self.data[at + np.repeat(self.start, size)].astype(U)
        part = mix64(((at.astype(U) << U(8)) | byte) ^ U(r))
        return mix64(np.add.reduceat(part, first) + size.astype(U) * U(r))


def text_column(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a text column; null texts are empty."""
    a = batch.column(batch.schema.get_field_index(name))
    if a.null_count:
        a = a.fill_null("")
    if not len(a):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    wide = pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type)
    off = np.frombuffer(a.buffers()[1], np.int64 if wide else np.int32)[a.offset:a.offset + len(a) + 1]
    raw = a.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    off = off.astype(np.int64)
    return off - off[0], data[off[0]:off[-1]]


def split_words(data: np.ndarray, bounds: np.ndarray, lower: bool) -> Words:
    """Words of documents ``data[bounds[d]:bounds[d+1]]``."""
    if lower:
        data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    n = len(data)
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    stops = word.copy()
    stops[:-1] &= ~word[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < n)]
    begins[edge] = word[edge]            # a document's first byte starts a word
    stops[edge - 1] = word[edge - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(stops) + 1
    first = np.searchsorted(start, bounds)
    w = Words(data, bounds, start, end, first, np.zeros(0, U))
    w.h = w.hash(R1)
    return w


def groups(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes."""
    d, n = 0, len(off) - 1
    while d < n:
        e = max(d + 1, int(np.searchsorted(off, off[d] + limit, "right")) - 1)
        e = min(e, n)
        yield d, e
        d = e


def word_groups(batch: pa.RecordBatch, text: str, lower: bool) -> Iterator[tuple[int, int, Words]]:
    off, data = text_column(batch, text)
    for d, e in groups(off):
        yield d, e, split_words(data[off[d]:off[e]], off[d:e + 1] - off[d], lower)


def window_hashes(h: np.ndarray, size: int, r: int) -> np.ndarray:
    """Hash of the ``size`` hashes from each position on (len(h) - size + 1 of them)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U)
    p = powers(r, len(h))
    s = np.zeros(len(h) + 1, U)
    np.cumsum(h * p, out=s[1:])
    inv = powers(pow(r, -1, 1 << 64), n)
    return mix64((s[size:size + n] - s[:n]) * inv)


def shingle_sets(w: Words, size: int) -> list[np.ndarray]:
    """Per document the sorted distinct hashes of its ``size``-word shingles;
    with fewer words the whole sequence is one shingle, with none no shingle."""
    all_h = window_hashes(w.h, size, RW1)
    out = []
    for d in range(len(w.first) - 1):
        a, b = int(w.first[d]), int(w.first[d + 1])
        if b - a >= size:
            out.append(np.unique(all_h[a:b - size + 1]))
        elif b > a:
            short = mix64(window_hashes(w.h[a:b], b - a, RW1) + U(b - a))
            out.append(short)
        else:
            out.append(np.zeros(0, U))
    return out


def stash_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stash`` that also tells the folder, for ``discard``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/stockroom/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the cluster's shared folder and read it
    back: the lineage is cut and survives lost executors."""
    return stash_at(df, name)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a stash that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def unused(name: str, columns: list[str]) -> str:
    """``name`` with as many underscores in front as make it none of
    ``columns`` (Spark tells names apart without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def signed(a: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark longs."""
    return a.view(np.int64) if a.flags.c_contiguous else np.ascontiguousarray(a).view(np.int64)
