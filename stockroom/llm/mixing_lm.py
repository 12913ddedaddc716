"""Operator 10: online logistic mixing of hashed-context bit predictors.

Method.  A text is the sequence of its words and one end.  A word is a path
of bits: the ``VOCABULARY`` most frequent training words have Huffman codes;
any other word is an escape code, then Huffman codes of its bytes and a stop.
So each text has one bit string, and the bit probabilities multiply to a
proper distribution over word sequences.  Each bit is predicted three times:
by its node alone (training counts), and by two contexts hashed together with
the node into slots of bit counts (``SLOTS_A_TOKEN`` for each training token,
between the powers of two ``LOG2_SLOTS``): the word before and the
two words before (inside a spelled word: two and four symbols).  The
predictions are combined in the logistic domain with weights that are chosen
by a gate (word or spelling, and how often the two slots were seen), updated
after every bit; an adaptive scale, also chosen by the gate, refines the
mixture.  The sum of log probabilities is the score; with the number of bytes
it gives bits per byte.

Training counts cover all training texts: each task fills its own tables and
emits them in blocks, Spark adds the blocks up.  What is sent to tasks is
bounded by the parameters: the counts, in the narrowest type and compressed,
which each worker opens once.  First weights come from all training texts,
each predicted without its own share of the counts: a gate's weights are the
logistic regression of its bits, one Newton step from ``START`` (tasks add up
gradients and curvatures, a few numbers a gate).
Weights then adapt inside segments of ``SEGMENT`` bits, which run side by side as vector lanes; contexts go on
across segments and whole texts are scored.

The unigram base score needs the count of every word; words outside the
vocabulary get theirs by an exact join.

Defined cases.  Null and empty texts are the one end.  Null and repeated
``doc_id`` stay as rows; a null id is no training row.  Without training rows
the base score is 0 for an end and the model has uniform codes.  Other
columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.kernels import U, discard, groups, mix64, stash, stash_at, text_column

VOCABULARY = 131_000
LOG2_SLOTS = (14, 22)  # fewest and most slots of a table
SLOTS_A_TOKEN = 8      # a word has some ten bits, each with a slot of its own in a context
BLOCK = 1 << 15        # slots of an emitted block
SEGMENT = 768          # bits of a lane
GROUP_BYTES = 3 << 17  # of text scored at once (its segments are the lanes)
COUNT_BYTES = 1 << 16  # of text counted or fitted at once: nothing there gains by more
START = np.array([0.6, 0.3, 0.3])  # weights from which the first ones are fitted
PIECE = 1 << 16        # bits that are fitted at once
RIDGE = 4.0            # what holds a gate of few bits to START
RATE, SCALE_RATE = 0.015, 0.002
SEEN = np.array([1, 8])            # slot counts at which the gate changes
GATES = 2 * 9
FLUSH = 400_000
MAX_WORD = 64          # bytes of a vocabulary word


def huffman(weights: list[int], first_node: int) -> tuple[list[list[int]], list[list[int]], list[tuple[int, int]]]:
    """(bits, nodes) of each symbol, and (left, right) weight of each node."""
    n = len(weights)
    if n == 1:
        return [[]], [[]], []
    heap = [(w, i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    up = [(-1, 0)] * (2 * n - 1)
    sides = []
    for k in range(n, 2 * n - 1):
        (wa, a), (wb, b) = heapq.heappop(heap), heapq.heappop(heap)
        up[a], up[b] = (k, 0), (k, 1)
        sides.append((wa, wb))
        heapq.heappush(heap, (wa + wb, k))
    bits, nodes = [], []
    for i in range(n):
        b, v, at = [], [], i
        while up[at][0] >= 0:
            at, bit = up[at]
            b.append(bit)
            v.append(first_node + at - n)
        bits.append(b[::-1])
        nodes.append(v[::-1])
    return bits, nodes, sides


@dataclass
class Coder:
    """Words as bit strings.  Symbols: words 0 .. n-1, escape n, end n + 1,
    bytes n + 2 + b, stop n + 258."""
    words: list[bytes]
    counts: list[int]
    ends: int
    others: int
    log2: int = LOG2_SLOTS[0]   # of the slots of a table
    index: dict = field(init=False)

    def __post_init__(self):
        n = self.n = len(self.words)
        self.index = {w: i for i, w in enumerate(self.words)}
        bits, nodes, sides = huffman([c for c in self.counts] + [self.others + 1, self.ends + 1], 0)
        spelled = [1] * 257
        for w in self.words:
            for b in w:
                spelled[b] += 1
            spelled[256] += 1
        bits2, nodes2, sides2 = huffman(spelled, len(sides))
        bits, nodes, sides = bits + bits2, nodes + nodes2, sides + sides2
        self.length = np.array([len(b) for b in bits], np.int64)
        self.at = np.append(0, self.length.cumsum())[:-1]
        self.bits = np.array([x for b in bits for x in b], np.uint8)
        self.nodes = np.array([x for v in nodes for x in v], np.int32)
        s = np.array(sides or [(1, 1)], np.float64)
        self.order0 = np.log((s[:, 1] + 0.1) / (s[:, 0] + 0.1)).astype(np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "index"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.index = {w: i for i, w in enumerate(self.words)}

    def stream(self, docs: list[bytes]):
        """Bits of texts: (word ids, words of each text, bits, place in the
        codes, slots of both contexts, spelling?, bits of each text, unknown words)."""
        n, get = self.n, self.index.get
        per_doc = [d.split() for d in docs]
        ids = np.array([get(w, -1) for ws in per_doc for w in [*ws, None]], np.int64)
        n_words = np.array([len(ws) + 1 for ws in per_doc], np.int64)
        ends = n_words.cumsum() - 1
        ids[ends] = n + 1
        flat = [w for ws in per_doc for w in [*ws, b""]]
        lost = np.flatnonzero(ids == -1)
        # symbols: one a word, or escape, bytes, stop
        spell = [flat[i] for i in lost]
        size = np.ones(len(ids), np.int64)
        size[lost] += np.array([len(w) + 1 for w in spell], np.int64)
        at = size.cumsum() - size
        sym = np.empty(int(size.sum()), np.int64)
        sym[at] = np.where(ids == -1, n, ids)
        inner = np.ones(len(sym), bool)
        inner[at] = False
        stops = at[lost] + size[lost] - 1
        inner[stops] = False
        sym[stops] = n + 258
        sym[inner] = np.frombuffer(b"".join(spell), np.uint8).astype(np.int64) + n + 2
        inner[stops] = True
        # what a word is as a context; unknown words by their bytes
        key = ids.astype(U) + U(1)
        if len(lost):
            starts = at[lost] + 1
            ends_at = starts + size[lost] - 1
            place = np.arange(len(sym)) - at[np.repeat(np.arange(len(ids)), size)]
            c = np.append(U(0), mix64((sym + 1).astype(U) * U(0x10001) + place.astype(U)).cumsum(dtype=U))
            key[lost] = mix64(c[ends_at] - c[starts]) | U(1 << 63)
        pos = np.arange(len(ids)) - np.repeat(ends - n_words + 1, n_words)
        p1 = np.append(U(0), key[:-1]) if len(key) else key
        p1[pos < 1] = 0
        p2 = np.append(U(0), p1[:-1]) if len(key) else key
        p2[pos < 1] = 0
        word = np.repeat(np.arange(len(ids), dtype=np.int32), size)
        c1, c2 = mix64(p1 + U(17))[word], mix64(mix64(p1 + U(29)) + p2)[word]
        back = [np.append(np.full(k, n, np.int64), sym[:-k]) if len(sym) >= k else sym for k in (1, 2, 3, 4)]
        depth = np.arange(len(sym)) - at[word]
        for k in range(4):
            back[k] = np.where(depth >= k + 1, back[k], n).astype(U)
        j = np.flatnonzero(inner)
        two = back[0][j] * U(0x1F123BB5) + back[1][j]
        c1[j] = mix64(two + U(101))
        c2[j] = mix64(two * U(0x9E3779B97F4A7C15) + back[2][j] * U(0x1F123BB5) + back[3][j] + U(211))
        # bits
        k = self.length[sym]
        total = int(k.sum())
        inside = np.repeat(self.at[sym] - (k.cumsum() - k), k)
        inside += np.arange(total)
        spread = self.nodes[inside].astype(U)
        spread *= U(0xD1342543DE82EF95)
        slots = []
        for c in (c1, c2):
            mixed = np.repeat(c, k)
            mixed ^= spread
            mixed *= U(0x9FB21C651E98DF25)
            mixed >>= U(64 - self.log2)
            slots.append(mixed.view(np.int64))
        per_doc = np.add.reduceat(np.add.reduceat(k, at), ends - n_words + 1) if len(docs) else k
        return (ids, n_words, self.bits[inside], inside, slots, np.repeat(inner, k), per_doc,
                list(zip(np.searchsorted(ends, lost).tolist(), spell)))


@dataclass
class Counts:
    """Bit counts of the slots of both contexts; opened in a worker."""
    log2: int
    blocks: dict[int, bytes]            # compressed; of the slots that were touched
    opened: tuple | None = None

    def _each(self) -> Iterator[tuple[int, np.ndarray]]:
        block = min(BLOCK, 1 << self.log2)
        for b, packed in self.blocks.items():
            yield b * block, _unpacked(packed).reshape(-1, 2)

    def raw(self) -> list[np.ndarray]:
        """Of each context the two counts of a slot as one number."""
        size = 1 << self.log2
        out = np.zeros((2 * size, 2), np.uint32)
        for at, c in self._each():
            out[at:at + len(c)] = np.minimum(c, 2 ** 32 - 1)
        out = out.view(U)[:, 0]
        return [out[:size], out[size:]]

    def predictions(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Of each context: predictions of the slots, and how often each was
        seen (0, 1, 2)."""
        if self.opened is None:
            size = 1 << self.log2
            tables, seen = np.zeros(2 * size, np.float32), np.zeros(2 * size, np.uint8)
            for at, c in self._each():
                tables[at:at + len(c)] = np.log((c[:, 1] + 0.4) / (c[:, 0] + 0.4))
                seen[at:at + len(c)] = np.searchsorted(SEEN, c.sum(axis=1), "right")
            self.opened = [tables[:size], tables[size:]], [seen[:size], seen[size:]]
        return self.opened


class Fitter:
    """Gradient and curvature of the gates' log loss at ``START``."""

    def __init__(self, coder: Coder, counts: Counts):
        self.coder, self.raw = coder, counts.raw()
        self.tag, self.own = np.zeros(0, np.int64), np.zeros(0, U)
        self.one = np.array([[1, 0], [0, 1]], np.uint32).view(U)[:, 0]
        self.total = np.zeros((GATES, 3, 4))    # curvature, gradient

    def _without_own(self, t: int, slots: np.ndarray, one: np.ndarray, ends: list[int]) -> np.ndarray:
        """(bits, 2) counts of context t for each bit, without those that the
        bit's own document made.  (Neither half of a difference is negative.)"""
        c = self.raw[t][slots]
        a = 0
        for b in ends:
            c[a:b] -= self._own(slots[a:b], one[a:b])
            a = b
        return c.view(np.uint32).reshape(-1, 2)

    def _own(self, slots: np.ndarray, one: np.ndarray) -> np.ndarray:
        """For each bit the sum of ``one`` over the bits of its slot.  Slots
        are added up in a small table; a bit whose place there belongs to
        another slot is sorted out."""
        size = min(1 << self.coder.log2, 1 << (8 * len(slots)).bit_length())
        if size > len(self.own):
            self.tag, self.own = np.zeros(size, np.int64), np.zeros(size, U)
        tag, own = self.tag, self.own
        place = slots & (size - 1)
        tag[place] = slots
        fits = tag[place] == slots
        if fits.all():
            np.add.at(own, place, one)
            out = own[place]
            own[place] = 0
            return out
        out = np.empty(len(slots), U)
        kept = place[fits]
        np.add.at(own, kept, one[fits])
        out[fits] = own[kept]
        own[kept] = 0
        _, which = np.unique(slots[~fits], return_inverse=True)
        rest = np.zeros(len(which), U)
        np.add.at(rest, which, one[~fits])
        out[~fits] = rest[which]
        return out

    def add(self, docs: list[bytes]) -> None:
        _, _, bits, inside, slots, spelled, per_doc, _ = self.coder.stream(docs)
        one, ends = self.one[bits], per_doc.cumsum().tolist()
        counts = [self._without_own(t, slots[t], one, ends) for t in range(2)]
        del slots, one
        for a in range(0, len(bits), PIECE):         # memory follows what a bit is, not what is made of it
            part = slice(a, a + PIECE)
            self._sum(bits[part], inside[part], spelled[part], [c[part] for c in counts])

    def _sum(self, bits: np.ndarray, inside: np.ndarray, spelled: np.ndarray, counts: list[np.ndarray]) -> None:
        x = np.empty((len(bits), 3), np.float32)
        x[:, 0] = self.coder.order0[self.coder.nodes[inside]]
        gate = spelled * np.uint8(9)
        for t, c in enumerate(counts):
            n = c[:, 0] + c[:, 1]
            for k, least in enumerate(SEEN):
                gate += (n >= least).astype(np.uint8) * np.uint8(3 if t == 0 else 1)
            c = c.astype(np.float32)
            c += np.float32(0.4)
            x[:, 1 + t] = np.log(c[:, 1] / c[:, 0])
        p = 1 / (1 + np.exp(-(x @ START.astype(np.float32))))
        err, curve = bits - p, np.sqrt(p * (1 - p))
        order = np.argsort(gate, kind="stable")       # a radix sort of small numbers
        upto = np.bincount(gate, minlength=GATES).cumsum()
        # summed in double precision: predictions of one gate are nearly collinear
        x, err, curve = (v[order].astype(np.float64) for v in (x, err, curve))
        a = 0
        for g, b in enumerate(upto.tolist()):
            if b > a:
                y = x[a:b] * curve[a:b, None]
                self.total[g, :, :3] += y.T @ y
                self.total[g, :, 3] += err[a:b] @ x[a:b]
            a = b


def weights(total: np.ndarray) -> np.ndarray:
    """(GATES, 4) first weights and scales from the sums of all tasks."""
    out = np.ones((GATES, 4))
    for g in range(GATES):
        out[g, :3] = START + np.linalg.solve(total[g, :, :3] + RIDGE * np.eye(3), total[g, :, 3])
    return out


def log_probabilities(coder: Coder, counts: Counts, first: np.ndarray, docs: list[bytes]):
    """(ids, n_words, ln probability of each doc, unknown words).

    Predictions are turned to the side of the bit that comes, so an update
    goes up the gradient of its log probability whatever the bit is."""
    ids, n_words, bits, inside, slots, spelled, per_doc, lost = coder.stream(docs)
    tables, seen = counts.predictions()
    lanes_of = -(-per_doc // SEGMENT)
    n_lanes = int(lanes_of.sum())
    count = np.full(n_lanes, SEGMENT, np.int64)          # bits of each lane
    last = lanes_of.cumsum() - 1
    some = lanes_of > 0
    count[last[some]] = (per_doc - (lanes_of - 1) * SEGMENT)[some]
    order = np.argsort(-count, kind="stable")
    rank = np.empty(n_lanes, np.int64)
    rank[order] = np.arange(n_lanes)
    # the bits of one step lie together, longest lane first
    step = np.arange(len(bits)) - np.repeat(count.cumsum() - count, count)
    active = np.bincount(step, minlength=1) if len(step) else np.zeros(0, np.int64)
    begin = active.cumsum() - active
    to = begin[step]
    to += np.repeat(rank, count)
    side = bits.astype(np.float32)
    side *= 2
    side -= 1
    row = np.empty((len(bits), 4), np.float32)           # three predictions, gate
    np.multiply(coder.order0[coder.nodes[inside]], side, out=row[:, 0])
    np.multiply(tables[0][slots[0]], side, out=row[:, 1])
    np.multiply(tables[1][slots[1]], side, out=row[:, 2])
    row[:, 3] = spelled * np.uint8(9) + seen[0][slots[0]] * np.uint8(3) + seen[1][slots[1]]
    placed = np.empty(len(bits), np.complex128)          # four numbers moved as one
    placed[to] = row.view(np.complex128)[:, 0]
    row = placed.view(np.float32).reshape(-1, 4)
    x0, x1, x2 = (np.ascontiguousarray(row[:, k]) for k in range(3))
    place = row[:, 3].astype(np.int64)
    place *= n_lanes
    state = np.repeat(first.astype(np.float32), n_lanes, axis=0).view(np.complex128)[:, 0]
    lane = np.arange(n_lanes)
    loss = np.zeros(n_lanes)
    rate, scale_rate, low = np.float32(RATE), np.float32(SCALE_RATE), np.float32(-60)
    with np.errstate(over="ignore"):                     # 1 / (1 + inf) is the 0 that is meant
        for b, n in zip(begin.tolist(), active.tolist()):
            at = place[b:b + n]
            at += lane[:n]
            y0, y1, y2 = x0[b:b + n], x1[b:b + n], x2[b:b + n]
            now = state.take(at)
            a0, a1, a2, sc = now.view(np.float32).reshape(-1, 4).T
            z = a0 * y0
            z += a1 * y1
            z += a2 * y2
            err = np.exp(z)
            err += 1
            np.divide(rate, err, out=err)
            a0 += err * y0
            a1 += err * y1
            a2 += err * y2
            fine = sc * z
            np.maximum(fine, low, out=fine)
            np.negative(fine, out=fine)
            miss = np.exp(fine)
            total = miss + 1
            loss[:n] += np.log(total)
            miss /= total
            miss *= z
            miss *= scale_rate
            sc += miss
            state[at] = now
    ln = np.zeros(len(docs))
    np.add.at(ln, np.repeat(np.arange(len(docs)), lanes_of), -loss[rank])
    return ids, n_words, ln, lost


def _lowered(batch: pa.RecordBatch, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    off, data = text_column(batch, "text")
    for d, e in groups(off, limit):
        raw = data[off[d]:off[e]].tobytes().lower()     # a group at a time: no copy of the whole batch
        at = (off[d:e + 1] - off[d]).tolist()
        yield d, e, [raw[a:b] for a, b in zip(at, at[1:])]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
    for batch in batches:
        for _, _, docs in _lowered(batch):
            for d in docs:
                seen.update(d.split())
            if len(seen) > FLUSH:
                yield rows()
                seen.clear()
    if seen:
        yield rows()


def _count_bits(shared):
    """Task: bit counts of the slots of both contexts, in blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        size = 1 << coder.log2
        block = min(BLOCK, size)
        counts = np.zeros((2, 2 * size), np.uint32)
        for batch in batches:
            for _, _, docs in _lowered(batch, COUNT_BYTES):
                _, _, bits, _, slots, *_ = coder.stream(docs)
                for t in range(2):
                    np.add.at(counts[t], 2 * slots[t] + bits, np.uint32(1))
        for t in range(2):
            for b in range(0, 2 * size, 2 * block):
                part = counts[t, b:b + 2 * block]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([(t * size + b // 2) // block], pa.int32()),
                         pa.array([_packed(part)], pa.binary())], names=["block", "counts"])
    return run


def _packed(part: np.ndarray) -> bytes:
    """Counts in the narrowest type that holds them, its width in front,
    compressed: most are small or none."""
    top = int(part.max())
    kind = np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64
    return zlib.compress(bytes([np.dtype(kind).itemsize]) + part.astype(kind).tobytes(), 1)


def _unpacked(packed) -> np.ndarray:
    raw = zlib.decompress(packed)
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.uint64)


def _add_blocks(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for c in batch.column("counts"):
            c = _unpacked(c.as_buffer())
            total = c if total is None else total + c
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([_packed(total)], pa.binary())],
                                         names=["block", "counts"])


def _fit_weights(coder, counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitter = None
        for batch in batches:
            for _, _, docs in _lowered(batch, COUNT_BYTES):
                fitter = fitter or Fitter(coder.value, counts.value)
                fitter.add(docs)
        if fitter:
            yield pa.RecordBatch.from_arrays([pa.array([fitter.total.ravel().tolist()], pa.list_(pa.float64()))], names=["w"])
    return run


@dataclass
class Model:
    coder: Broadcast
    counts: Broadcast
    weights: np.ndarray                 # (GATES, 4)
    n_tokens: int
    n_distinct: int


def fit(texts: DataFrame) -> tuple[Model, DataFrame]:
    """(model, counts of all words) of training ``texts`` (text)."""
    spark = texts.sparkSession
    context = spark.sparkContext
    words = stash(texts.mapInArrow(_count_words, "word binary, n long")
                  .groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    ends = texts.count()
    n_tokens, n_distinct = (total["n"] or 0) + ends, total["v"] + (1 if ends else 0)
    # bounded: VOCABULARY words of MAX_WORD bytes; written first, as the tasks'
    # candidates would else meet in the driver
    most, at = stash_at(words.filter(F.length("word") <= MAX_WORD).orderBy(F.col("n").desc(), "word").limit(VOCABULARY), "vocabulary")
    most = most.orderBy(F.col("n").desc(), "word").toArrow()
    known = most["n"].to_pylist()
    log2 = int(np.clip(np.ceil(np.log2(max(1, SLOTS_A_TOKEN * n_tokens))), *LOG2_SLOTS))
    coder = context.broadcast(Coder(most["word"].to_pylist(), known, ends, n_tokens - ends - sum(known), log2))
    discard(spark, at)
    blocks = "block int, counts binary"
    # a task emits a block once, so a block's group is one row a task, added as they come
    parts = texts.mapInArrow(_count_bits(coder), blocks).groupBy("block").applyInArrow(_add_blocks, blocks)
    # bounded: two tables of 2 ** log2 slots
    counts = context.broadcast(Counts(log2, {row["block"]: bytes(row["counts"]) for row in parts.toLocalIterator()}))
    got = np.zeros((GATES, 3, 4))
    for row in texts.mapInArrow(_fit_weights(coder, counts), "w array<double>").collect():   # a few numbers a task
        got += np.array(row["w"]).reshape(got.shape)
    return Model(coder, counts, weights(got), n_tokens, n_distinct), words


SCORED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("n_known", T.LongType()), T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
    T.StructField("n_bytes", T.LongType()), T.StructField("rare", T.ArrayType(T.BinaryType())),
])


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, counts = model.coder.value, model.counts.value
        c = np.array([*coder.counts, 0, coder.ends], np.float64)
        log_p = np.log10((c + 0.1) / (model.n_tokens + 0.1 * (model.n_distinct + 1)))
        for batch in batches:
            for d, e, docs in _lowered(batch):
                ids, n_words, ln, lost = log_probabilities(coder, counts, model.weights, docs)
                doc = np.repeat(np.arange(len(docs)), n_words)
                there = ids >= 0
                rare: list[list] = [[] for _ in docs]
                for i, w in lost:
                    rare[i].append(w)
                cols = [n_words, np.bincount(doc[there], weights=c[ids[there]] > 0, minlength=len(docs)).astype(np.int64),
                        np.bincount(doc[there], weights=log_p[ids[there]], minlength=len(docs)), ln / np.log(10),
                        np.array([len(x) for x in docs], np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(d, e - d), batch.column(1).slice(d, e - d), *map(pa.array, cols),
                     pa.array(rare, pa.list_(pa.binary()))], names=SCORED.fieldNames())
    return run


def score(docs: DataFrame, train) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte.  ``train``: condition on ``doc_id`` of
    the rows to learn from."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model, words = fit(base.filter(train).select("text"))
    n, v = model.n_tokens, model.n_distinct
    done = stash(base.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
                 .mapInArrow(_score(model), SCORED), "scored")
    rare = (done.select("row", F.explode("rare").alias("word")).groupBy("row", "word").agg(F.count("*").alias("tf"))
            .join(words.hint("merge"), "word", "left")
            .select("row", "tf", F.coalesce("n", F.lit(0)).alias("c"))
            .groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("more"),
                                F.sum(F.col("tf") * F.log10((F.col("c") + 0.1) / F.lit(n + 0.1 * (v + 1)))).alias("extra")))
    return done.drop("rare").join(rare, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("extra", F.lit(0.0))).alias("base_score"),
        "score", (-F.col("score") * float(np.log2(10)) / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))
