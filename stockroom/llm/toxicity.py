"""Operator 2: toxicity by nearest labelled examples.

Method.  Examples are a bounded sample of labelled documents: at most
``TOXIC_EXAMPLES`` and ``CLEAN_EXAMPLES`` rows, taken in the order of a hash
of the id.  Terms are lower-case words, their first four to seven letters, and each
of these with its density in the text (a power of two of words a use); those
that tell the classes apart (log-likelihood ratio of at least ``MIN_G2``, at
most ``MAX_TERMS`` that mark toxic examples and as many that mark clean ones)
span a TF-IDF space.  Every document is scored by its
``NEIGHBOURS`` nearest examples by exact cosine: an inverted index holds the
postings of a term in blocks of ``BLOCK`` examples with the largest weight of
each block; the blocks of highest bound are scored first, then all blocks
whose bound reaches the worst neighbour found there, so it misses none.
Neighbours vote by their cosine squared, re-weighted from the sample to the
class shares of all labelled rows, with ``PRIOR`` votes for the overall
share.  A text without any term gets the toxic share of such examples.

Labels are the only thing learned from; label, lang, source and doc_id never
enter a score.  The driver holds the sample's terms and vectors only.

Defined cases.  Null texts count as empty.  A label row with a null id or
label is ignored; ids labelled more than once are toxic if any row says so.
Without examples, or without toxic ones, every score is the toxic share (0).
Equal cosines go to the smaller example id.  Other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import unused

TOXIC_EXAMPLES, CLEAN_EXAMPLES = 4000, 8000
MAX_TERMS = 4096       # of each sign
MIN_G2 = 24.0
MIN_USES = 3           # examples of its class a term must occur in
NEIGHBOURS = 15
BLOCK = 64
FIRST = 4              # blocks scored first
PRIOR = 0.25
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7)
SPARSEST = 9           # density level of a use in 2**9 words or more
CACHE = 500_000

WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    return ["=" + word] + [word[:n] for n in PREFIXES if len(word) >= n]


def at_density(term: str, uses: int, n_words: int) -> str:
    return f"{term}|{min(SPARSEST, (n_words // uses).bit_length() - 1)}"


def features(text: str) -> set[str]:
    words = WORD.findall(text.lower())
    uses: Counter = Counter()
    for w, c in Counter(words).items():
        for t in terms_of(w):
            uses[t] += c
    return uses.keys() | {at_density(t, c, len(words)) for t, c in uses.items()}


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: documents with each term, by class; flushed when large."""
    seen = (Counter(), Counter())

    def flush():
        keys = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([seen[1][k] for k in keys], pa.int64()),
             pa.array([seen[0][k] for k in keys], pa.int64())], names=["term", "toxic", "clean"])
        for c in seen:
            c.clear()
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            seen[label].update(features(text.as_py() or ""))
            if len(seen[0]) + len(seen[1]) > 2 * CACHE:
                yield from flush()
    yield from flush()


def log_likelihood(a: int, b: int, n_a: int, n_b: int) -> float:
    """G2 of a of n_a against b of n_b, negative if rarer in the first."""
    total, out = n_a + n_b, 0.0
    for x, n in ((a, n_a), (b, n_b)):
        for seen, rate in ((x, (a + b) / total), (n - x, 1 - (a + b) / total)):
            if seen:
                out += 2 * seen * math.log(seen / (n * rate))
    return out if a * n_b > b * n_a else -out


class Vectoriser:
    """TF-IDF over the chosen terms, unit length."""

    def __init__(self, idf: dict[str, tuple[int, float]]):
        self.idf = idf
        self.plain = {t.partition("|")[0] for t in idf}
        self.cache: dict[str, tuple] = {}

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = WORD.findall(text.lower())
        hits = []
        for w in set(words):
            f = self.cache.get(w)
            if f is None:
                if len(self.cache) > CACHE:
                    self.cache.clear()
                f = self.cache[w] = tuple(t for t in terms_of(w) if t in self.plain)
            if f:
                hits.append((w, f))
        weight: dict[int, float] = {}
        if hits:
            count = Counter(words)
            uses: Counter = Counter()
            for w, f in hits:
                for t in f:
                    uses[t] += count[w]
            for t, c in uses.items():
                for name in (t, at_density(t, c, len(words))):
                    if name in self.idf:
                        i, x = self.idf[name]
                        weight[i] = (1 + math.log(c)) * x
        idx = np.array(sorted(weight), np.int64)
        val = np.array([weight[i] for i in idx.tolist()])
        norm = float(np.sqrt((val * val).sum()))
        return (idx, val / norm) if norm else (np.zeros(0, np.int64), np.zeros(0))


class BlockMaxIndex:
    """Postings by term with the largest weight of each block of examples."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(vectors)
        blocks = -(-self.n // BLOCK) if self.n else 0
        posting: list[list] = [[] for _ in range(n_terms)]
        self.top = np.zeros((n_terms, blocks))
        for e, (idx, val) in enumerate(vectors):
            for t, v in zip(idx.tolist(), val.tolist()):
                posting[t].append((e, v))
                self.top[t, e // BLOCK] = max(self.top[t, e // BLOCK], v)
        self.docs = [np.array([p[0] for p in ps], np.int64) for ps in posting]
        self.vals = [np.array([p[1] for p in ps]) for ps in posting]
        self.block = [d // BLOCK for d in self.docs]

    def search(self, idx: np.ndarray, val: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The k examples of largest cosine (above 0), best first, ties to
        the earlier example: [(cosine, example)]."""
        if not self.n or not len(idx):
            return []
        bound = val @ self.top[idx]
        score = np.zeros(self.n)

        def add(blocks: np.ndarray) -> None:
            for t, v in zip(idx.tolist(), val.tolist()):
                keep = blocks[self.block[t]]
                score[self.docs[t][keep]] += v * self.vals[t][keep]
        first = np.zeros(len(bound), bool)
        first[np.argsort(-bound, kind="stable")[:FIRST]] = True
        add(first & (bound > 0))
        at = np.flatnonzero(score > 0)
        worst = np.partition(score[at], len(at) - k)[len(at) - k] if len(at) >= k else 0.0
        # a hair above the bound, for the rounding of sums in another order
        rest = ~first & (bound > 0) & (bound * (1 + 1e-12) >= worst)
        if rest.any():
            add(rest)
            at = np.flatnonzero(score > 0)
        if len(at) > k:
            at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
        return [(float(score[e]), int(e)) for e in at[np.lexsort((at, -score[at]))][:k]]


class Model:
    """What is sent to tasks; bounded by the sample."""

    def __init__(self, idf, ids, labels, vectors, share: float, weight: tuple[float, float]):
        self.idf, self.ids, self.labels, self.vectors = idf, ids, labels, vectors
        self.share, self.weight = share, weight
        bare = [y for y, v in zip(labels, vectors) if not len(v[0])]
        votes = sum(weight[y] for y in bare)
        self.bare = (sum(weight[1] for y in bare if y) + PRIOR * share) / (votes + PRIOR) if votes else share

    def prepare(self):
        """Index over the examples that have a term, in the order of ids."""
        order = sorted((i, y, v) for i, y, v in
                       ((i, y, k) for k, (i, y) in enumerate(zip(self.ids, self.labels))) if len(self.vectors[v][0]))
        self.kept = [(i, y) for i, y, _ in order]
        self.index = BlockMaxIndex([self.vectors[v] for _, _, v in order], len(self.idf))
        self.vectorise = Vectoriser(self.idf)
        return self

    def score(self, text: str) -> tuple[float, list[int]]:
        """(score, ids of the neighbours that voted)."""
        near = self.index.search(*self.vectorise(text), NEIGHBOURS)
        if not near:
            return self.bare, []
        up = PRIOR * self.share
        down = PRIOR
        for sim, e in near:
            v = sim * sim * self.weight[self.kept[e][1]]
            up += v * self.kept[e][1]
            down += v
        return min(1.0, max(0.0, up / down)), [self.kept[e][0] for _, e in near]


def _vectors(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectorise = Vectoriser(idf)
        for batch in batches:
            got = [vectorise(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(1), pa.array([g[0].tolist() for g in got], pa.list_(pa.int64())),
                 pa.array([g[1].tolist() for g in got], pa.list_(pa.float64()))], names=["doc_id", "y", "idx", "val"])
    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Model from the labelled rows of ``labels`` (doc_id, toxic) whose text
    is in ``docs``."""
    known = (labels.filter("doc_id is not null and toxic is not null")
             .groupBy(F.col("doc_id").cast("long").alias("lid")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("y")))
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pick = None
    for y, most in ((1, TOXIC_EXAMPLES), (0, CLEAN_EXAMPLES)):
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("lid"), "lid").limit(most)
        pick = part if pick is None else pick.unionByName(part)
    # at most TOXIC_EXAMPLES + CLEAN_EXAMPLES rows of (id, label): a bounded
    # broadcast; a doc_id that repeats is one example, its smallest text
    sample = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
              .join(F.broadcast(pick), F.col("doc_id") == F.col("lid"))
              .groupBy("doc_id", "y").agg(F.min("text").alias("text"))
              .select("text", "y", "doc_id")).cache()
    s = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_tox, n_clean = s.get(1, 0), s.get(0, 0)
    total = n.get(0, 0) + n.get(1, 0)
    share = n.get(1, 0) / total if total else 0.0
    if not n_tox or not n_clean:
        sample.unpersist()
        return Model({}, [], [], [], share, (1.0, 1.0))
    counts = (sample.select("text", "y").mapInArrow(_count_terms, "term string, toxic long, clean long")
              .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .withColumn("more", F.col("toxic") / n_tox - F.col("clean") / n_clean)).cache()
    # a proxy order that keeps the clearest of each sign
    marks = [counts.filter((F.col("more") > 0) & (F.col("toxic") >= MIN_USES)).orderBy(F.col("more").desc(), "term"),
             counts.filter((F.col("more") < 0) & (F.col("clean") >= MIN_USES)).orderBy("more", "term")]
    weight = (n.get(0, 0) / n_clean, n.get(1, 0) / n_tox)
    idf = {}
    for part in marks:
        scored = sorted(((abs(log_likelihood(r["toxic"], r["clean"], n_tox, n_clean)), r["term"], r["toxic"], r["clean"])
                         for r in part.limit(8 * MAX_TERMS).collect()), key=lambda x: (-x[0], x[1]))
        for g2, term, a, b in scored[:MAX_TERMS]:
            if g2 >= MIN_G2:
                idf[term] = (len(idf), 1 + math.log(total / max(1.0, a * weight[1] + b * weight[0])))
    counts.unpersist()
    rows = sample.mapInArrow(_vectors(idf), "doc_id long, y int, idx array<long>, val array<double>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["y"], r["idx"]))
    sample.unpersist()
    return Model(idf, [r["doc_id"] for r in rows], [r["y"] for r in rows],
                 [(np.array(r["idx"], np.int64), np.array(r["val"])) for r in rows], share, weight)


def _score(shared, at_text: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.prepare()
        for batch in batches:
            got = [model.score(t.as_py() or "") for t in batch.column(at_text)]
            keep = [batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array([g[0] for g in got], pa.float64()),
                 pa.array([int(g[0] >= THRESHOLD) for g in got], pa.int32()),
                 pa.array([g[1] for g in got], pa.list_(pa.int64()))],
                names=[*names, "score", "predicted", "evidence"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (score >= THRESHOLD) and
    evidence (ids of the neighbours, nearest first); columns of these names
    are replaced."""
    new = ("score", "predicted", "evidence")
    base = docs.select(*[c for c in docs.columns if c not in new])
    base = base.withColumn("text", F.col("text").cast("string"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType(base.schema.fields + [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
        T.StructField("evidence", T.ArrayType(T.LongType()))])
    return base.mapInArrow(_score(shared, base.columns.index("text"), base.columns), schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents scored toxic; the columns stay, also
    those with names of the operator's own."""
    model = fit(docs, labels)
    aside: dict[str, str] = {}
    for c in docs.columns:
        if c in ("score", "predicted", "evidence"):
            aside[c] = unused(f"_{c}", [*docs.columns, *aside.values()])
    flagged = score(docs.withColumnsRenamed(aside), model).filter("predicted = 0").drop("score", "predicted", "evidence")
    return flagged.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)
