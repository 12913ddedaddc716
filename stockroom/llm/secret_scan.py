"""Operator 5: secret scan with multipart credential linking.

Method.  One pass finds *strong* spans (kinds ``assign``, ``access``,
``hex``, see ``FINDERS``) and *weak* parts: short identifiers, short or
unnamed secrets, and endpoints.  A weak part alone is no finding.  Parts of a
document are interval-joined: the scope of a part reaches ``REACH`` code
points to both sides, scopes are cut into bins of that width, and parts meet
in an equi-join on (row, bin) with the overlap as a further condition.  A
weak part is reported only when a complementary part lies in its scope: a
secret next to an identifier or endpoint, an identifier or endpoint next to
a secret.  A bin holds at most REACH / 4 parts, so one long document or a
text full of parts can't make a group that grows without bound.

Spans are code points, end exclusive.  Defined cases: null and empty texts
have no spans; rows are told apart by their place, not by ``doc_id``, so
null and repeated ids keep their own spans; equal spans of two kinds are both
reported; other columns of ``docs`` are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import stash, unused

REACH = 200            # code points between parts of one credential

# fixed patterns of the strong kinds
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.A)
HEX = re.compile(r"[0-9a-f]{12,}", re.A)
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 12, 18, 16

# weak parts
USER = re.compile(r"""(?i:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@/_.-]{3,})""", re.A)
BLOB = re.compile(r"[A-Za-z0-9+/]{32,}={0,2}", re.A)
PLACE = re.compile(r"(?:https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|ftp|ssh)://[^\x20\x09-\x0D\"'<>]{4,}", re.A)
WEAK_SECRET_MIN, WEAK_ACCESS_MIN = 6, 12

KINDS = ["assign", "access", "hex", "weak_secret", "weak_id", "endpoint"]
#: what each kind is as a part of a credential
ROLE = {"assign": "secret", "hex": "secret", "weak_secret": "secret",
        "access": "id", "weak_id": "id", "endpoint": "place"}

SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("rank", T.IntegerType()),
                     T.StructField("end", T.IntegerType())])
FOUND = T.StructType([T.StructField("rid", T.LongType()), T.StructField("doc_id", T.LongType()),
                      T.StructField("th", T.LongType()), T.StructField("spans", T.ArrayType(SPAN)),
                      T.StructField("weak", T.ArrayType(SPAN))])


def find(text: str) -> tuple[list, list]:
    """(strong, weak) parts of a text as (start, rank of kind, end)."""
    strong, weak = [], []
    if "=" in text or ":" in text:
        for m in ASSIGN.finditer(text):
            n = m.end(1) - m.start(1)
            if n >= ASSIGN_MIN:
                strong.append((m.start(), 0, m.end()))
            elif n >= WEAK_SECRET_MIN:
                weak.append((m.start(), 3, m.end()))
        weak.extend((m.start(), 4, m.end()) for m in USER.finditer(text))
        if "://" in text:
            weak.extend((m.start(), 5, m.end()) for m in PLACE.finditer(text))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            n = m.end() - m.start()
            if n >= ACCESS_MIN:
                strong.append((m.start(), 1, m.end()))
            elif n >= WEAK_ACCESS_MIN:
                weak.append((m.start(), 4, m.end()))
    for m in HEX.finditer(text):
        if m.end() - m.start() >= HEX_MIN:
            strong.append((m.start(), 2, m.end()))
        elif re.search("[a-f]", m[0]) and re.search("[0-9]", m[0]):
            weak.append((m.start(), 3, m.end()))
    for m in BLOB.finditer(text):
        s = m[0]
        if re.search("[A-Z]", s) and re.search("[a-z]", s) and re.search("[0-9]", s):
            weak.append((m.start(), 3, m.end()))
    # a weak part inside a strong span, or found by two patterns, says nothing new
    weak = [w for w in dict.fromkeys(weak) if not any(a <= w[0] and w[2] <= b for a, _, b in strong)]
    return sorted(strong), sorted(weak)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda spans: [{"start": a, "rank": k, "end": b} for a, k, b in spans]
    for batch in batches:
        strong, weak = [], []
        for text in batch.column(3):
            s, w = find(text.as_py() or "")
            strong.append(as_rows(s))
            weak.append(as_rows(w))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(strong, kind), pa.array(weak, kind)],
            names=FOUND.fieldNames())


def _parts(found: DataFrame, col) -> DataFrame:
    role = F.element_at(F.array(*[F.lit(ROLE[k]) for k in KINDS]), F.col("p.rank") + 1)
    return found.select("rid", F.explode(col).alias("p")).select(
        "rid", "p.start", "p.rank", "p.end", role.alias("role"))


def link(found: DataFrame) -> DataFrame:
    """(rid, linked): the weak parts with a complementary part in scope."""
    some = found.filter(F.size("weak") > 0)
    weak = _binned(_parts(some, F.col("weak")), REACH)
    parts = _binned(_parts(some, F.concat("spans", "weak")), 0).select(
        "rid", "bin", F.col("start").alias("s2"), F.col("end").alias("e2"), F.col("role").alias("r2"))
    complementary = (F.col("role") == "secret") != (F.col("r2") == "secret")
    near = (F.col("s2") < F.col("end") + REACH) & (F.col("e2") > F.col("start") - REACH)
    hit = weak.alias("w").join(
        parts.alias("q"), (F.col("w.rid") == F.col("q.rid")) & (F.col("w.bin") == F.col("q.bin"))
        & complementary & near, "left_semi")
    return (hit.select("rid", F.struct("start", "rank", "end").alias("p")).distinct()
            .groupBy("rid").agg(F.collect_list("p").alias("linked")))     # at most a document's parts


def _binned(parts: DataFrame, reach: int) -> DataFrame:
    """One row for each bin of REACH code points that the part, widened by
    ``reach`` to both sides, touches."""
    low = F.floor(F.greatest(F.lit(0), F.col("start") - reach) / REACH)
    return parts.withColumn("bin", F.explode(F.sequence(low, F.floor((F.col("end") + reach) / REACH))))


def scan(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, th (``xxhash64(text)``), ``spans`` (strong)
    and ``linked`` (weak, with a complement in scope), each an array of
    (start, rank in KINDS, end)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = stash(docs.select(F.monotonically_increasing_id().alias("rid"),
                              F.col("doc_id").cast("long").alias("doc_id"),
                              F.xxhash64(text).alias("th"), text.alias("text"))
                  .mapInArrow(_scan, FOUND), "secrets")
    none = F.array().cast(T.ArrayType(SPAN))
    return (found.join(link(found), "rid", "left")
            .select("doc_id", "th", "spans", F.coalesce("linked", none).alias("linked")))


def spans_text(spans):
    """kind:start:end by start, then kind as listed, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda p: F.concat_ws(
        ":", F.element_at(kinds, p["rank"] + 1), p["start"].cast("string"), p["end"].cast("string"))), ",")


def _redact(at_cuts: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, cuts = batch.column(names.index("text")), batch.column(names.index(at_cuts))
            new = []
            for t, c in zip(texts, cuts):
                t, c = t.as_py(), c.as_py()
                if c:
                    out, at = [], 0
                    for p in sorted(c, key=lambda p: (p["start"], -p["end"])):
                        if p["end"] <= at:
                            continue
                        if p["start"] >= at:
                            out += [t[at:p["start"]], "[SECRET]"]
                        at = p["end"]
                    t = "".join(out) + t[at:]
                new.append(t)
            cols = [pa.array(new, pa.string()) if n == "text" else batch.column(i)
                    for i, n in enumerate(names) if n != at_cuts]
            yield pa.RecordBatch.from_arrays(cols, names=[n for n in names if n != at_cuts])
    return run


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every reported span replaced by ``[SECRET]`` in ``text``
    (overlapping spans by one); all columns stay, whatever their names."""
    own, th, at_cuts = (unused(n, docs.columns) for n in ("id_of_cuts", "th_of_cuts", "cuts"))
    cuts = (scan(docs).filter((F.size("spans") > 0) | (F.size("linked") > 0))
            .select(F.col("doc_id").alias(own), F.col("th").alias(th),
                    F.concat("spans", "linked").alias(at_cuts))
            .dropDuplicates([own, th]))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = docs.join(cuts, F.col("doc_id").cast("long").eqNullSafe(F.col(own)) & (F.xxhash64(text) == F.col(th)),
                       "left").drop(own, th)
    return joined.mapInArrow(_redact(at_cuts), T.StructType(
        [T.StructField("text", T.StringType()) if f.name == "text" else f for f in joined.schema.fields
         if f.name != at_cuts]))
