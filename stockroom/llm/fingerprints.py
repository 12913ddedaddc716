"""Operator 9: document fingerprints, DataFrame functions only.

Method.  The fingerprint of a text is the bottom-``K`` sketch of its shingle
hashes: the K smallest distinct 64-bit hashes of its 5-word shingles (the
whole sequence is one shingle if there are fewer words, none without words).
Sketches merge: the K smallest of the union of two sketches is the sketch of
the joint shingles, so texts may be sketched in parts.  From sketches come
estimates of resemblance, containment and the distinct shingle count; they
are exact while both sets have at most K shingles.

Words are runs outside ``\\x20\\x09-\\x0D``, unchanged.  Values that are used
more than once in an expression are bound with a one-element ``transform``,
so Spark does not evaluate them again.

Defined cases.  Null texts count as empty; an empty set has an empty sketch,
resemblance 1 with another empty one and 0 with any other.  Documents are in
descending ``doc_id`` order, equal ids by text, null ids last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SHINGLE = 5
K = 256
SPACE = 2.0 ** 64
DOCS_PER_BUCKET = 400      # of the ordering in ``with_next``
MAX_BUCKETS = 16384        # bounds what the driver holds (one id a bucket)


def bind(value: Column, body) -> Column:
    """body(value), evaluating ``value`` once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """64-bit hashes of all shingles, in order, repeats included."""
    def of(h):
        n = F.size(h)
        full = F.transform(F.sequence(F.lit(1), n - (size - 1)),
                           lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(size)]))
        short = F.array(F.xxhash64(F.lit("short"), h))
        return F.when(n >= size, full).when(n > 0, short).otherwise(F.array().cast("array<bigint>"))
    return bind(F.transform(words(text), lambda w: F.xxhash64(w)), of)


def sketch(text: Column, k: int = K) -> Column:
    """Sorted array of the k smallest distinct shingle hashes."""
    return F.slice(F.array_distinct(F.sort_array(shingle_hashes(text))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the joint shingles of two sketched parts."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_by(df: DataFrame, key: str, sketch_col: str, k: int = K) -> DataFrame:
    """(key, sketch): the merged sketch of each group.  Hashes are made
    distinct and ranked, so no task holds a group; at most k stay."""
    one = df.select(key, F.explode(sketch_col).alias("h")).distinct()
    low = one.withColumn("r", F.row_number().over(Window.partitionBy(key).orderBy("h"))).filter(F.col("r") <= k)
    return low.groupBy(key).agg(F.sort_array(F.collect_list("h")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A or B| (0 to 1)."""
    return bind(F.struct(a.alias("a"), b.alias("b")), lambda s: bind(
        merge(s["a"], s["b"], k),
        lambda u: F.when(F.size(u) == 0, F.lit(1.0)).otherwise(
            F.size(F.array_intersect(F.array_intersect(u, s["a"]), s["b"])) / F.size(u))))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    last = (F.element_at(a, -1).cast("double") + SPACE / 2) / SPACE
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / last)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that are in B (0 to 1; 1 for an empty A)."""
    j = resemblance(a, b, k)
    n = distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), j * (n + distinct_count(b, k)) / (1 + j) / n))


def to_string(a: Column) -> Column:
    """Hashes as 16 hex digits each, joined by '-'."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "-")


def _bucket_tops(docs: DataFrame) -> list[int]:
    """Ids that exist in ``docs``, ascending: the largest of each bucket."""
    n = docs.select("doc_id").filter("doc_id is not null").count()
    if not n:
        return []
    m = min(MAX_BUCKETS, max(1, n // DOCS_PER_BUCKET))
    parts = [(i + 1) / m for i in range(m)]
    tops = docs.agg(F.percentile_approx("doc_id", parts, max(10000, 10 * m)).alias("t"),
                    F.max("doc_id").alias("m")).first()
    return sorted({*tops["t"], tops["m"]})


def with_next(docs: DataFrame, col: str, into: str, prepare=lambda df: df) -> DataFrame:
    """``docs`` with ``col`` of the next document, descending ``doc_id``
    (after the last: the first).  Ids are cut into buckets; the largest
    documents of a bucket also go, as guests, to the end of the bucket
    above it, so each bucket finds its next rows in one local sort.
    ``prepare`` adds columns (such as ``col``) after rows are dealt out."""
    tops = _bucket_tops(docs) or [0]
    steps = [1 << i for i in reversed(range(len(tops).bit_length()))]
    bounds = F.lit(tops).cast("array<bigint>")
    smaller = F.aggregate(   # binary search: how many tops are smaller than doc_id
        F.lit(steps), F.lit(0),
        lambda at, s: F.when((at + s <= len(tops))
                             & (F.element_at(bounds, F.least(at + s, F.lit(len(tops)))) < F.col("doc_id")),
                             at + s).otherwise(at))
    # rows of null ids come last, in bucket 0
    placed = docs.withColumn("_own", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(smaller))
    is_top = F.coalesce(F.element_at(bounds, F.col("_own") + 1) == F.col("doc_id"), F.lit(False))
    above = F.when(F.col("_own") == len(tops) - 1, F.lit(0)).otherwise(F.col("_own") + 1)
    stay = F.struct(F.col("_own").alias("b"), F.lit(False).alias("guest"))
    guest = F.struct(above.alias("b"), F.lit(True).alias("guest"))
    placed = (placed.withColumn("_p", F.explode(F.when(is_top, F.array(stay, guest)).otherwise(F.array(stay))))
              .withColumn("_bucket", F.col("_p.b")).withColumn("_guest", F.col("_p.guest")).drop("_p", "_own"))
    placed = prepare(placed.repartition("_bucket"))
    w = Window.partitionBy("_bucket").orderBy(F.col("_guest"), F.col("doc_id").desc_nulls_last(), F.col(col))
    return placed.withColumn(into, F.lead(col).over(w)).filter(~F.col("_guest")).drop("_bucket", "_guest")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n/2) code points replaced by the first
    as many (or all) of ``other``."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of every row's text and of its edited text, with the
    likeness to the edited text's and to the next document's."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = with_next(base, "rec", "nxt", lambda df: df.withColumn(
        "rec", F.struct("text", sketch(F.col("text")).alias("fp"))))
    # without any id there is no guest: the last row is its own next
    both = both.withColumn("nxt", F.coalesce("nxt", "rec"))
    both = both.withColumn("ed", edited(F.col("rec.text"), F.col("nxt.text")))
    both = both.withColumn("efp", F.explode(F.array(sketch(F.col("ed")))))   # evaluated once
    return both.select(
        "doc_id", F.length("rec.text").cast("long").alias("n_chars"), F.sha2("ed", 256).alias("edited_sha256"),
        to_string(F.col("rec.fp")).alias("fingerprint"), to_string(F.col("efp")).alias("edited_fingerprint"),
        resemblance(F.col("rec.fp"), F.col("efp")).alias("near_edited"),
        resemblance(F.col("rec.fp"), F.col("nxt.fp")).alias("near_next"),
        distinct_count(F.col("rec.fp")).alias("n_distinct"))
