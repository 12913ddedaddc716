"""Operator 4: nearest neighbours by a hash-prefix forest.

Method.  Rows are dealt into shards of about ``SHARD`` rows.  A shard is an
index of ``TREES`` trees: each tree has a random hyperplane hash string of
``BITS`` bits for every row and keeps the strings as one sorted array.  A
query descends in every tree to its place; the rows that share a prefix of
length x with it are a range around that place.  The ranges of all trees are
then ascended at the same pace, from long prefixes to short ones: at each
level the rows of all ranges get a vote, until the ranges have met rows
``ASCENT`` times as often as candidates are wanted.  The rows with most votes
(that is, the largest sum of prefix lengths over the trees) are the
candidates; their cosines are computed exactly, in double precision.

The stated queries meet every shard in blocks: queries are packed
``QUERY_BLOCK`` to a row and joined on the shard number, and a shard's index
is built once and kept while its blocks pass.  A shard's five best per query
are merged by a grouping, so no pair of row and query is ever a Spark row.
Every row is indexed and none is capped; of rows with equal votes those with
smaller ids go first, so any number of equal vectors gives the right ties.

Defined cases.  Null vectors, and those that are zero, empty or hold null or
non-finite components, take no part; nor do rows with a null ``vec_id``.
Vectors of different lengths do not meet.  A row is not its own neighbour:
rows of the query's ``vec_id`` are left out.  Queries with no other row give
no result.  Rows that repeat a ``vec_id`` are rows of
their own: each is found, and each query row gets its own results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD = 16384
TREES = 64
BITS = 24              # of a hash string
CANDIDATE_SHARE = 0.15  # of a shard's rows
MIN_CANDIDATES = 1024
ASCENT = 40
QUERY_BLOCK = 512
NEAREST = 5

PACKED = "dim int, shard int, ids array<long>, vectors array<binary>"


def hash_strings(x: np.ndarray) -> np.ndarray:
    """(trees, rows): the hash strings of rows, as integers."""
    planes = np.random.default_rng(20240611).standard_normal((x.shape[1], TREES * BITS))
    bits = (x @ planes > 0).reshape(len(x), TREES, BITS)
    return (bits @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).T


class Forest:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.unit = self.vectors / np.linalg.norm(self.vectors, axis=1, keepdims=True)
        keys = hash_strings(self.unit)
        perm = np.argsort(keys, axis=1, kind="stable")
        self.sorted = np.take_along_axis(keys, perm, axis=1)
        self.place = np.argsort(perm, axis=1).astype(np.int32)       # of each row in each tree
        self.wanted = max(MIN_CANDIDATES, int(np.ceil(CANDIDATE_SHARE * len(ids))))

    def ranges(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(trees, queries, BITS + 1): where the rows lie that share a prefix
        of each length with the query."""
        shift = np.arange(BITS, -1, -1, dtype=np.int64)
        low = (keys[:, :, None] >> shift) << shift
        both = [(np.searchsorted(s, x.ravel()).reshape(x.shape),
                 np.searchsorted(s, (x + (1 << shift)).ravel()).reshape(x.shape)) for s, x in zip(self.sorted, low)]
        return np.stack([b[0] for b in both]), np.stack([b[1] for b in both])

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows met on the synchronous ascent, those with most votes.
        ``low``, ``high``: (trees, BITS + 1)."""
        n = len(self.ids)
        if n <= self.wanted:
            return np.arange(n)
        steps = np.zeros((TREES, n + 1), np.int16)
        tree = np.arange(TREES)
        met = 0
        for depth in range(BITS, -1, -1):
            steps[tree, low[:, depth]] += 1
            np.subtract.at(steps, (tree, high[:, depth]), 1)
            met += int((high[:, depth] - low[:, depth]).sum())
            if met >= ASCENT * self.wanted:
                break
        votes = np.take_along_axis(steps.cumsum(axis=1, dtype=np.int16), self.place, axis=1).sum(axis=0, dtype=np.int32)
        cut = np.partition(votes, n - self.wanted)[n - self.wanted]
        sure = np.flatnonzero(votes > cut)
        return np.append(sure, np.flatnonzero(votes == cut)[:self.wanted - len(sure)])

    def search(self, ids: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[list, list]]:
        """(ids, cosines) of the nearest rows of each query."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        low, high = self.ranges(hash_strings(unit))
        for i, (q, v) in enumerate(zip(ids.tolist(), vectors)):
            c = self.candidates(low[:, i], high[:, i])
            c = c[self.ids[c] != q]
            x = self.vectors[c]
            cos = (x * v).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((v * v).sum()))
            best = np.lexsort((self.ids[c], -cos))[:NEAREST]
            yield self.ids[c][best].tolist(), cos[best].tolist()


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    ok = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(v, lambda x: x != 0)
    return (df.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).filter(F.coalesce(ok, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim")))


def _pack(names: list[str]):
    """Group: its ids and vectors as one row, vectors as bytes."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        v = rows.column("v").combine_chunks()
        flat = v.flatten().to_numpy(zero_copy_only=False).astype("<f8")
        row = {"q": pa.array([rows.column("q").to_pylist()], pa.list_(pa.int64()))} if "q" in rows.column_names else {}
        return pa.table({**{n: pa.array([k.as_py()], pa.int32()) for n, k in zip(names, key)}, **row,
                         "ids": pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())),
                         "v": pa.array([flat.tobytes()], pa.large_binary()).cast(pa.binary())})
    return run


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    built, forest = None, None
    for batch in batches:
        for row in range(batch.num_rows):
            dim, shard = batch.column("dim")[row].as_py(), batch.column("shard")[row].as_py()

            def matrix(name: str) -> np.ndarray:
                return np.frombuffer(batch.column(name)[row].as_buffer(), "<f8").reshape(-1, dim)
            if built != (dim, shard):
                forest = Forest(np.array(batch.column("ids")[row].values, np.int64), matrix("v"))
                built = (dim, shard)
            got = list(forest.search(np.array(batch.column("q_ids")[row].values, np.int64), matrix("q_v")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("q")[row].values, batch.column("q_ids")[row].values,
                 pa.array([g[0] for g in got], pa.list_(pa.int64())),
                 pa.array([g[1] for g in got], pa.list_(pa.float64()))], names=["q", "query_id", "ids", "scores"])


def nearest(rows: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the
    NEAREST rows of ``rows`` found, largest cosine first."""
    data, asked = _usable(rows, id_col, vector_col), _usable(queries, id_col, vector_col)
    n, m = data.count(), asked.count()
    shards, blocks = max(1, -(-n // SHARD)), max(1, -(-m // QUERY_BLOCK))
    part = lambda k, salt: F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(k)).cast("int")
    packed = (data.groupBy("dim", part(shards, 1).alias("shard"))
              .applyInArrow(_pack(["dim", "shard"]), "dim int, shard int, ids array<long>, v binary"))
    # queries are told apart by their place: their ids may repeat
    asked = (asked.withColumn("q", F.monotonically_increasing_id()).groupBy("dim", part(blocks, 2).alias("block"))
             .applyInArrow(_pack(["dim", "block"]), "dim int, block int, q array<long>, ids array<long>, v binary")
             .select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                     "q", F.col("ids").alias("q_ids"), F.col("v").alias("q_v")))
    pairs = packed.hint("merge").join(asked, ["dim", "shard"])
    found = pairs.mapInArrow(_search, "q long, query_id long, ids array<long>, scores array<double>")
    best = (found.select("q", "query_id", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
            .groupBy("q", "query_id").agg(F.slice(F.sort_array(F.collect_list(
                F.struct((-F.col("x.scores")).alias("far"), F.col("x.ids").alias("id")))), 1, NEAREST).alias("best")))
    return best.select("query_id", F.posexplode("best").alias("k", "b")).select(
        "query_id", (F.col("k") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"),
        (-F.col("b.far")).alias("score"))
