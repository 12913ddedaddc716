"""Operator 11: fill-in-middle transformation by a sparse exception index.

Method.  Texts stay UTF-8 bytes.  Of a group of documents only the multibyte
characters are recorded: the byte position of each and the running sum of
the bytes beyond one that they take (``ExceptionIndex``).  ``searchsorted``
in that list turns a byte cut into a code-point cut and back; all between two
exceptions is ASCII and follows by arithmetic.  A text is cut into units,
lines or characters.  The cuts of all documents of a group are found in one
vectorised step, and the parts are slices of the bytes, never decoded.

The random numbers of a document are the first four 8-digit groups of the
sha256 of ``seed:doc_id``, so a row's result depends on its id and text
alone: no task order, no state, a retried task gives the same rows.

Defined cases.  Null and empty texts stay as they are (form ``plain``, no
units, an empty output); so do texts that hold a sentinel, whatever their
length.  A null id counts as an empty one.  Repeated rows give repeated rows.
An empty table gives no rows.  Other columns are not looked at, whatever
their names.  Work is one pass without a shuffle; memory follows the Arrow
batch and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import groups, text_column

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = ("lines", "characters")

RESULT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType()),
])


class ExceptionIndex:
    """Code-point and byte positions of UTF-8 bytes, by their multibyte
    characters alone.  Positions must lie between two characters."""

    def __init__(self, data: np.ndarray):
        self.byte = np.flatnonzero(data >= 0xC0)
        lead = data[self.byte]
        extra = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate([[0], np.cumsum(extra)])
        self.char = self.byte - self.excess[:-1]

    def to_char(self, byte):
        return byte - self.excess[np.searchsorted(self.byte, byte, "left")]

    def to_byte(self, char):
        return char + self.excess[np.searchsorted(self.char, char, "left")]


class LineUnits:
    """Units ``[^\\n]*\\n|[^\\n]+`` of documents ``data[bounds[d]:bounds[d+1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, index: ExceptionIndex):
        self.bounds, self.ends = bounds, np.flatnonzero(data == 10) + 1
        self.first = np.searchsorted(self.ends, bounds[:-1], "right")
        whole = np.searchsorted(self.ends, bounds[1:], "right") - self.first
        last = np.zeros(len(whole), np.int64)        # bytes behind the last line feed
        some = whole > 0
        last[some] = self.ends[(self.first + whole - 1)[some]]
        last[~some] = bounds[:-1][~some]
        self.n = whole + (bounds[1:] > last)
        self.whole = whole

    def cut(self, k: np.ndarray) -> np.ndarray:
        """Byte position behind the first k units of each document."""
        at = np.where(k > self.whole, self.bounds[1:], self.bounds[:-1])
        inner = (k > 0) & (k <= self.whole)
        at[inner] = self.ends[(self.first + k - 1)[inner]]
        return at


class CharacterUnits:
    """Each code point is a unit."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, index: ExceptionIndex):
        self.index = index
        at = index.to_char(bounds)
        self.start, self.n = at[:-1], np.diff(at)

    def cut(self, k: np.ndarray) -> np.ndarray:
        return self.index.to_byte(self.start + k)


def _transform(unit: str, rate: int, spm: int, sentinels: tuple[str, str, str]):
    marks = [s.encode() for s in sentinels]

    def group(data: np.ndarray, bounds: np.ndarray, h: list[np.ndarray]):
        index = ExceptionIndex(data)
        units = (LineUnits if unit == "lines" else CharacterUnits)(data, bounds, index)
        raw = data.tobytes()
        one, two = h[0] % (units.n + 1), h[1] % (units.n + 1)
        a, b = units.cut(np.minimum(one, two)), units.cut(np.maximum(one, two))
        plain = (h[2] % 100 >= rate) | (np.diff(bounds) == 0)
        for d in range(len(plain)):
            if not plain[d]:
                plain[d] = any(raw.find(m, bounds[d], bounds[d + 1]) >= 0 for m in marks)
        at = index.to_char(np.stack([bounds[:-1], a, b]))
        p, s, m = marks
        out = []
        for d, (lo, x, y, hi) in enumerate(zip(bounds[:-1].tolist(), a.tolist(), b.tolist(), bounds[1:].tolist())):
            if plain[d]:
                out.append(raw[lo:hi])
            elif h[3][d] % 100 < spm:
                out.append(b"".join([s, raw[y:hi], p, raw[lo:x], m, raw[x:y]]))
            else:
                out.append(b"".join([p, raw[lo:x], s, raw[y:hi], m, raw[x:y]]))
        form = np.where(plain, "plain", np.where(h[3] % 100 < spm, "spm", "psm"))
        return [pa.array(units.n, pa.int64()), pa.array(form.tolist(), pa.string()),
                pa.array(at[1] - at[0], pa.int64(), mask=plain), pa.array(at[2] - at[1], pa.int64(), mask=plain),
                pa.array(out, pa.binary()).cast(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off, data = text_column(batch, "text")
            h = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, 6)]
            for d, e in groups(off):
                cols = group(data[off[d]:off[e]], off[d:e + 1] - off[d], [x[d:e] for x in h])
                yield pa.RecordBatch.from_arrays([batch.column(0)[d:e], *cols], names=RESULT.fieldNames())
    return run


def transform(docs: DataFrame, unit: str = "lines", rate: int = 100, spm: int = 50, seed: int = 7,
              sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n (units), form (plain,
    psm or spm), prefix_chars and middle_chars (code points; null if plain)
    and output.  ``rate`` percent of the texts are cut, ``spm`` percent of
    these start with the suffix."""
    if unit not in UNITS:
        raise ValueError(f"unit {unit!r} is none of {UNITS}")
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       digest.alias("digest"))
    rows = rows.select("doc_id", "text", *[F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k}")
                                           for k in range(4)])
    return rows.mapInArrow(_transform(unit, rate, spm, sentinels), RESULT)


def restore(output: str | Column, form: str | Column,
            sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text again, from output and form alone."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    prefix, suffix, middle = sentinels

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        one = F.substring_index(body, second, 1)
        rest = F.substring(body, F.length(one) + len(second) + 1, F.length(body))
        two = F.substring_index(rest, middle, 1)
        return one, two, F.substring(rest, F.length(two) + len(middle) + 1, F.length(rest))
    p, s, m = parts(prefix, suffix)
    s2, p2, m2 = parts(suffix, prefix)
    return F.when(form == "psm", F.concat(p, m, s)).when(form == "spm", F.concat(p2, m2, s2)).otherwise(output)
