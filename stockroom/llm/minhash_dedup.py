"""Operator 3: near-duplicate groups by a signature-coordinate inverted join.

Method.  A document is the set of its distinct 5-word shingles.  Documents
with equal sets form a class; only classes are compared.  A class has a
signature of ``M`` minimum hashes, posted under (coordinate, value) pairs.
Two sets of similarity J agree in each coordinate with probability J, so a
pair is a candidate when at least ``t`` coordinates agree (at J = 0.85, M =
256, t = 192 the expected count is 217.6 with deviation 5.7; fewer than t has
odds of about 1e-5, at J = 0.7 the odds of t or more are about 5 %).  The
similarity is a parameter; ``limits`` derives t and the other bounds from it
so that the odds of missing a link stay the same.

*Skip*: values that only one class holds can't collide and are not posted,
and a class that shares too few of its first coordinates with any other
(``Limits.funnel``) is left out before its other coordinates are made.  *Prefix*: in
the common order (rarest pair first), two classes that share at least t of M
pairs share one of the first M - t + 1 pairs of each, so the most frequent
pairs of a class - those of boilerplate lines - are never merged.  Within a
posting list no all-pairs are made.  Members are joined with the hub of the
list (first the member whose lists are longest in total, later rounds take
others); confirmed links are closed into components, and rounds go on while
the pairs of *different* components that meet in a list outnumber the
postings and still shrink.  Then just those remaining pairs are compared,
each at its first common list.  Sizes must allow J (100 * smaller >= percent *
larger), and every candidate is confirmed on full shingle sets.

The joins that move sets and texts are always sort-merge joins, so the plan
is alike at every size.

Defined cases.  Null and empty texts, and texts without words, have an empty
set, no links and are their own component.  A null ``doc_id`` gives a null
component and ``kept`` true.  Rows that repeat a ``doc_id`` count as one node
of the graph.  Ties go to the smaller ``doc_id``.  Other columns pass
through ``near_duplicates`` untouched (names of its own outputs excepted).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.window import Window

from stockroom.llm.components import connected_components
from stockroom.llm.kernels import U, mix64, seeds, shingle_sets, signed, stash, unused, word_groups

SHINGLE = 5
M = 256                # signature coordinates
LOW = 1536             # low bits compared
FUNNEL = (16, 64)      # first coordinates looked at before the others are made
PERCENT = 85           # 100 * intersection >= percent * union
# odds of missing a link of just this similarity: by coordinates, by low bits, by the steps of the funnel
MISS, MISS_LOW, MISS_FUNNEL = 1.1e-5, 3.5e-6, 2e-7

SIGNED = T_.StructType([
    T_.StructField("doc_id", T_.LongType()),
    T_.StructField("th", T_.LongType()),
    T_.StructField("n_shingles", T_.LongType()),
    T_.StructField("c1", T_.LongType()),
    T_.StructField("c2", T_.LongType()),
    T_.StructField("sig", T_.ArrayType(T_.IntegerType(), False)),
])
SETS = T_.StructType([
    T_.StructField("cls", T_.LongType()),
    T_.StructField("hashes", T_.ArrayType(T_.LongType(), False)),
])
SKETCHED = T_.StructType([
    T_.StructField("cls", T_.LongType()),
    T_.StructField("size", T_.IntegerType()),
    T_.StructField("sig", T_.ArrayType(T_.IntegerType(), False)),
    T_.StructField("bits", T_.ArrayType(T_.LongType(), False)),
])


@dataclass(frozen=True)
class Limits:
    """Bounds for links of at least ``percent``.  ``t``: agreeing coordinates
    of a candidate pair; ``apart``: low bits that may differ; ``funnel``:
    (n, t), a class goes on if t of its first n coordinates are shared."""
    percent: int
    t: int
    apart: int
    funnel: tuple[tuple[int, int], ...]


def _at_least(n: int, p: float, odds: float) -> int:
    """The largest k that n trials of chance p fall short of with at most these odds."""
    def exactly(k: int) -> float:
        ways = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
        return math.exp(ways + k * math.log(p) + (n - k) * math.log(1 - p))
    k, short = 0, exactly(0)
    while short <= odds and k < n:
        k += 1
        short += exactly(k)
    return k


@lru_cache
def limits(percent: int = PERCENT) -> Limits:
    j = percent / 100
    # an unequal coordinate has an unequal low bit half of the time
    return Limits(percent, _at_least(M, j, MISS), LOW - _at_least(LOW, (1 + j) / 2, MISS_LOW),
                  tuple((n, max(1, _at_least(n, j, MISS_FUNNEL))) for n in FUNNEL))


def signature(s: np.ndarray, n: int) -> np.ndarray:
    """The first n coordinates of a non-empty set, as 32-bit values."""
    mul, add = (seeds(LOW, 11) | U(1))[:n, None], seeds(LOW, 12)[:n, None]
    low = np.full((n, 1), 0xFFFFFFFFFFFFFFFF, U)
    for i in range(0, len(s), 512):
        low = np.minimum(low, (s[None, i:i + 512] * mul + add).min(axis=1, keepdims=True))
    return (mix64(low[:, 0]) >> U(32)).astype(np.uint32).view(np.int32)


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head = FUNNEL[-1]
    for batch in batches:
        ids, th = batch.column(0), batch.column(1)
        for d, e, w in word_groups(batch, "text", lower=True):
            sets = shingle_sets(w, SHINGLE)
            c1 = [np.add.reduce(s) for s in sets]
            c2 = [np.add.reduce(mix64(s ^ U(0x5851F42D4C957F2D))) for s in sets]
            sig = [signature(s, head) for s in sets if len(s)]
            at = np.append(0, np.cumsum([head if len(s) else 0 for s in sets])).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                ids.slice(d, e - d), th.slice(d, e - d),
                pa.array(np.array([len(s) for s in sets], np.int64)),
                pa.array(signed(np.array(c1, U))),
                pa.array(signed(np.array(c2, U))),
                pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sig) if sig else np.zeros(0, np.int32))),
            ], names=SIGNED.fieldNames())


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of sets, and the lowest bit of each coordinate, packed."""
    for batch in batches:
        sig = [signature(np.array(h.values, np.int64).view(U), LOW) for h in batch.column(1)]
        low = [np.packbits((x & 1).astype(np.uint8)).view(np.int64).tolist() for x in sig]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(h.values) for h in batch.column(1)], pa.int32()),
             pa.array([x[:M].tolist() for x in sig], pa.list_(pa.int32())), pa.array(low, pa.list_(pa.int64()))],
            names=SKETCHED.fieldNames())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for d, e, w in word_groups(batch, "text", lower=True):
            sets = shingle_sets(w, SHINGLE)
            at = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(d, e - d),
                 pa.ListArray.from_arrays(pa.array(at), pa.array(signed(np.concatenate(sets))))],
                names=SETS.fieldNames())


def _matches(x: str, y: str):
    return F.aggregate(F.zip_with(x, y, lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, v: s + v)


def _sets_of(ids: DataFrame, where: DataFrame, texts: DataFrame) -> DataFrame:
    """(cls, hashes) of the classes ``ids`` (cls).  ``where``: (cls, doc_id,
    th), a row of ``texts`` (doc_id, th, text) that holds the class's set."""
    at = where.join(ids, "cls", "left_semi")
    return stash(texts.hint("merge").join(at, ["doc_id", "th"]).dropDuplicates(["cls"])
                 .select("cls", "text").mapInArrow(_sets, SETS), "sets")


def _side(reps: DataFrame, name: str) -> DataFrame:
    return reps.select(F.col("cls").alias(name), F.col("sig").alias("s" + name), F.col("size").alias("n" + name),
                       F.col("bits").alias("l" + name))


def _may_link(lim: Limits):
    """Size, then packed low bits, then all coordinates."""
    apart = sum((F.bit_count(F.element_at("la", i).bitwiseXOR(F.element_at("lb", i))) for i in range(2, LOW // 64 + 1)),
                F.bit_count(F.element_at("la", 1).bitwiseXOR(F.element_at("lb", 1))))
    return ((100 * F.least("na", "nb") >= lim.percent * F.greatest("na", "nb")) & (apart <= lim.apart)
            & (_matches("sa", "sb") >= lim.t))


def _candidates(pairs: DataFrame, reps: DataFrame, lim: Limits) -> DataFrame:
    """Pairs (a, b) whose signatures and set sizes agree enough."""
    return pairs.join(_side(reps, "a"), "a").join(_side(reps, "b"), "b").filter(_may_link(lim)).select("a", "b")


def _confirm(pairs: DataFrame, sets: DataFrame, lim: Limits) -> DataFrame:
    """Pairs (a, b) of class ids whose full sets are similar enough."""
    pairs = stash(pairs, "pairs")
    sa = sets.select(F.col("cls").alias("a"), F.col("hashes").alias("ha"))
    sb = sets.select(F.col("cls").alias("b"), F.col("hashes").alias("hb"))
    inter = F.size(F.array_intersect("ha", "hb"))
    return stash(pairs.join(sa.hint("merge"), "a").join(sb.hint("merge"), "b")
                 .withColumn("i", inter)
                 .filter(100 * F.col("i") >= lim.percent * (F.size("ha") + F.size("hb") - F.col("i")))
                 .select("a", "b"), "confirmed")


def _post(reps: DataFrame, n: int) -> DataFrame:
    return (reps.select("cls", F.posexplode(F.slice("sig", 1, n)).alias("c", "v"))
            .select("cls", F.xxhash64("c", "v").alias("key")))


def _shared(posts: DataFrame) -> DataFrame:
    return posts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")


def postings(reps: DataFrame, lim: Limits) -> DataFrame:
    """(cls, key, n): the prefix postings; n is the length of the whole list."""
    mine = Window.partitionBy("cls")
    posts = _post(reps, M)
    return (posts.join(_shared(posts).hint("merge"), "key")
            .select("cls", "key", "n", F.count("*").over(mine).alias("k"),
                    F.row_number().over(mine.orderBy("n", "key")).alias("r"))
            .filter(F.col("r") <= F.col("k") - (lim.t - 1))
            .select("cls", "key", "n"))


def _open_pairs(lab: DataFrame) -> int:
    """How many pairs of different components meet in a list (over all lists)."""
    by = lab.groupBy("key", "comp").agg(F.count("*").cast("double").alias("c"))
    per = by.groupBy("key").agg((F.pow(F.sum("c"), 2) - F.sum(F.col("c") * F.col("c"))).alias("p"))
    return int((per.agg(F.sum("p")).first()[0] or 0) / 2)


def _through_funnel(reps: DataFrame, lim: Limits) -> DataFrame:
    for n, t in lim.funnel:
        posts = _post(reps, n)
        some = (posts.join(_shared(posts).hint("merge"), "key").groupBy("cls").agg(F.count("*").alias("c"))
                .filter(F.col("c") >= t).select("cls"))
        reps = stash(reps.join(some, "cls", "left_semi"), "survivors")
    return reps


def class_components(reps: DataFrame, where: DataFrame, texts: DataFrame, lim: Limits) -> DataFrame:
    """(node, component) of the linked class representatives.  ``reps``:
    (cls, sig), one row per class, with the coordinates that the funnel needs;
    ``where`` and ``texts`` as for ``_sets_of``."""
    sets = _sets_of(_through_funnel(reps, lim).select("cls"), where, texts)
    reps = stash(sets.mapInArrow(_sketches, SKETCHED), "sketches")
    lists = stash(postings(reps, lim), "postings")
    n_posts = lists.count()
    sets = _sets_of(lists.select("cls").distinct(), where, texts)
    weight = lists.groupBy("cls").agg(F.sum("n").alias("w"))
    lab = lists.withColumn("comp", F.col("cls"))
    comp, rounds, last = None, 0, None
    while True:
        if rounds == 0:
            first = F.struct(F.col("w"), -F.col("cls"))
            members = lab.join(weight, "cls")
        else:
            first = F.struct(F.xxhash64("cls", "key", F.lit(rounds)), F.col("cls"))
            members = lab
        hub = stash(members.groupBy("key").agg(F.max_by(F.struct("cls", "comp"), first).alias("hub")), "hubs")
        star = (lab.join(hub, "key").filter("comp <> hub.comp")
                .select(F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b")).distinct())
        links = _confirm(_candidates(star, reps, lim), sets, lim)
        if comp is not None:
            links = links.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b")))
        comp = connected_components(links)
        lab = stash(lists.join(comp, F.col("cls") == F.col("node"), "left")
                    .select("cls", "key", "n", F.coalesce("component", "cls").alias("comp")), "open")
        left, rounds = _open_pairs(lab), rounds + 1
        if left <= n_posts or (last is not None and left > 0.9 * last):
            break
        last = left

    # what the hubs did not settle: members of different components in a list
    unsettled = (lab.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                 .filter("lo < hi").select("key"))
    keys = lab.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("nks")) \
              .select("cls", F.transform("nks", lambda s: s["key"]).alias("keys"))      # at most M
    open_ = stash(lab.join(unsettled, "key").join(keys, "cls").join(reps, "cls"), "left")
    x = open_.select("key", F.col("comp").alias("ca"), F.col("keys").alias("ka"), F.col("cls").alias("a"),
                     F.col("sig").alias("sa"), F.col("size").alias("na"), F.col("bits").alias("la"))
    y = open_.select("key", F.col("comp").alias("cb"), F.col("keys").alias("kb"), F.col("cls").alias("b"),
                     F.col("sig").alias("sb"), F.col("size").alias("nb"), F.col("bits").alias("lb"))
    cond = ((x.key == y.key) & (x.a < y.b) & (x.ca != y.cb) & _may_link(lim)
            & (F.element_at(F.array_intersect("ka", "kb"), 1) == x.key))
    rest = _confirm(x.join(y, cond).select("a", "b"), sets, lim)
    return connected_components(rest.unionByName(
        comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, th, n_shingles, c1, c2, sig) of every row; c1 and c2 identify
    the set, th the text."""
    return _texts(docs).mapInArrow(_signatures, SIGNED)


KEY = ["c1", "c2", "n_shingles"]


def set_classes(signed_docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Classes of equal sets: (c1, c2, n_shingles, cls, doc_id, th, sig), with
    a row that holds the set; and links (a, b) between classes that rows of
    one ``doc_id`` belong to (None if no id has two).  ``cls`` is the smallest
    ``doc_id`` of the class; where classes have the same, all but one take a
    hash instead."""
    some = signed_docs.filter("n_shingles > 0 and doc_id is not null")
    classes = stash(some.groupBy(*KEY).agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("sig").alias("sig"))
                    .select(*KEY, "rep.doc_id", "rep.th", "sig"), "classes")
    key = F.struct(*KEY)
    crowded = stash(classes.groupBy("doc_id").agg(F.min(key).alias("one"), F.count("*").alias("k")).filter("k > 1")
                    .select("doc_id", "one"), "crowded")
    classes = classes.withColumn("cls", F.col("doc_id"))
    if not crowded.isEmpty():
        classes = stash(classes.drop("cls").join(crowded, "doc_id", "left").withColumn(
            "cls", F.when(F.col("one").isNull() | (F.col("one") == key), F.col("doc_id"))
            .otherwise(F.xxhash64("doc_id", *KEY))).drop("one"), "classes")
    several = stash(some.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
                    .filter("lo <> hi").select("doc_id"), "several")
    if several.isEmpty():
        return classes, None
    held = stash(some.select("doc_id", *KEY).join(several, "doc_id").join(classes.select(*KEY, "cls"), KEY)
                 .select("doc_id", "cls").distinct(), "held")
    least = held.groupBy("doc_id").agg(F.min("cls").alias("a"))
    return classes, held.join(least, "doc_id").filter("a <> cls").select("a", F.col("cls").alias("b"))


def near_duplicate_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.  Links
    have a similarity of at least ``percent`` / 100."""
    signed_docs = stash(signatures(docs), "signatures")
    classes, same_id = set_classes(signed_docs)
    where = classes.select("cls", "doc_id", "th")
    comp = class_components(classes.select("cls", "sig"), where, _texts(docs), limits(percent))
    if same_id is not None:
        comp = connected_components(same_id.unionByName(comp.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    named = stash(classes.join(comp, F.col("cls") == F.col("node"), "left")
                  .select(*KEY, F.col("doc_id").alias("own"), F.coalesce("component", "cls").alias("component")),
                  "components")
    if same_id is not None:
        # a class may be named by a hash: the smallest doc_id of the component instead
        least = named.groupBy("component").agg(F.min("own").alias("least"))
        named = named.join(least, "component").select(*KEY, F.col("least").alias("component"))
    out = signed_docs.join(named.select(*KEY, "component"), KEY, "left")
    # equal sets share a class, so component is its smallest doc_id or less
    return out.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that are near copies of a smaller id.
    Rows that repeat an id are one document: they stay or go together."""
    name = unused("gone", docs.columns)
    gone = near_duplicate_groups(docs, percent).filter("not kept").select(F.col("doc_id").alias(name))
    return docs.join(gone.distinct(), F.col("doc_id") == F.col(name), "left_anti")
