"""Operator 12: languages of words and texts by a linear-chain CRF.

Method.  A text is a chain of words (runs of ASCII letters and bytes beyond
ASCII; ASCII and Latin-1 letters in lower case).  A word's features are its
affixes, its n-grams (all of bytes, hashed into ``ROWS`` rows of weights)
and the languages whose lexicon holds it.  Transitions between languages are
learned with them, by AdaGrad on the conditional likelihood of chains that
switch between languages: spans of labelled texts, dealt anew.
Forward-backward gives each word the probability of every language; a run of
words of one most likely language is a span.  The text gets the language with the most
probability summed over its words, and the mean as score.

All chains of a group of texts are run through at once: the first word of a
text forgets what came before, blocks of ``BLOCK`` words are multiplied up
side by side, vectors are carried over the blocks, and every block is then
run through from its own start.  So a text of any length is scored whole.

Scale.  Scoring is one pass without a shuffle; the model (a fixed number of
rows of weights for each language) goes to all tasks.  Fitting takes at most
``SAMPLE`` labelled rows of each language, and ``SPAN`` characters of each, taken
at a place that the row's hash tells; these two bounds are parameters.

Defined cases.  Null texts and texts without a letter are ``und`` with score
0 and no spans; so are all texts if no row is labelled.  Ties go to the
language that sorts first.  Rows with null text or lang teach nothing.  Null and repeated
``doc_id`` stay rows; copies are scored alike.  An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockroom.llm.infill import ExceptionIndex
from stockroom.llm.kernels import R1, Words, groups, text_column

ROW_BITS = 18
ROWS = (1 << ROW_BITS) + 1
SAMPLE = 500           # labelled rows of a language
SPAN = 2500            # characters of a labelled row
GRAMS = (2, 3, 4)      # bytes
PREFIXES = (1, 2, 3)
SUFFIXES = (1, 2, 3, 4)
HOLDERS = 2            # texts of a language that make a word one of its lexicon
BLOCK = 128
EPOCHS = 4
BATCH = 8000           # words
RATE = 0.2
DECAY = 1e-4
UNKNOWN = "und"
U = np.uint64

LABELLED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())]))),
])


# -- words and features ------------------------------------------------------

def words_of(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Words of the documents ``data[bounds[d]:bounds[d+1]]``."""
    data = np.where((data >= 65) & (data <= 90), data | 32, data).astype(np.uint8)
    # capital letters of Latin-1 (but the multiplication sign) are C3 80 to C3 9E
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    second = second[(data[second] >= 0x80) & (data[second] <= 0x9E) & (data[second] != 0x97)]
    data[second] += 0x20
    word = ((data >= 97) & (data <= 122)) | (data >= 0x80)
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    stops[:-1] &= ~word[1:]
    edge = bounds[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = word[edge]
    stops[edge - 1] = word[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    w = Words(data, bounds, start, end, np.searchsorted(start, bounds), np.zeros(0, U))
    w.h = w.hash(R1)
    return w


def _rows(packed: np.ndarray, kind: int) -> np.ndarray:
    """Rows of weights by multiplicative hash; row 0 is left for what is no
    feature."""
    return ((((packed + U(kind << 40)) * U(0x9E3779B97F4A7C15)) >> U(64 - ROW_BITS)) + U(1)).astype(np.int32)


@dataclass
class Features:
    """Rows of the words' features: ``grams`` of every byte of a word (those
    of word i from ``first[i]`` on), ``affixes`` of every word."""
    first: np.ndarray
    size: np.ndarray
    grams: list[np.ndarray]
    affixes: list[np.ndarray]

    def total(self, weights: np.ndarray) -> np.ndarray:
        """Summed weights (words, languages)."""
        inner = weights[self.grams[0]]
        for g in self.grams[1:]:
            inner += weights[g]
        out = np.add.reduceat(inner, self.first)
        for a in self.affixes:
            out += weights[a]
        return out

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, word) of every feature."""
        n = len(self.first)
        of_byte = np.repeat(np.arange(n), self.size)
        row = np.concatenate(self.grams + self.affixes)
        word = np.concatenate([of_byte] * len(self.grams) + [np.arange(n)] * len(self.affixes))
        return row[row > 0], word[row > 0]


def features(w: Words) -> Features:
    size = (w.end - w.start).astype(np.int64)
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first - w.start, size)
    left = np.repeat(w.end, size) - at                       # bytes to the word's end
    padded = np.concatenate([w.data, np.zeros(4, np.uint8)]).astype(U)
    packed = {1: padded[at]}
    for n in range(2, max(GRAMS + PREFIXES + SUFFIXES) + 1):
        packed[n] = (packed[n - 1] << U(8)) | padded[at + n - 1]
    grams = [np.where(left >= n, _rows(packed[n], n), np.int32(0)) for n in GRAMS]
    affixes = [np.where(size >= n, _rows(packed[n][first], 16 + n), np.int32(0)) for n in PREFIXES]
    affixes += [np.where(size >= n, _rows(packed[n][first + np.maximum(size - n, 0)], 32 + n), np.int32(0)) for n in SUFFIXES]
    return Features(first, size, grams, affixes)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray          # (ROWS, languages)
    lexicon: np.ndarray          # sorted hashes of words
    holders: np.ndarray          # (len(lexicon), languages): whose lexicon has the word
    by_holder: np.ndarray        # (languages + 1, languages): weights of these; the last if no one has it
    start: np.ndarray
    trans: np.ndarray

    def lexical(self, h: np.ndarray) -> np.ndarray:
        """(words, languages + 1) lexicon features."""
        out = np.zeros((len(h), len(self.langs) + 1), np.float32)
        at = np.minimum(np.searchsorted(self.lexicon, h), max(0, len(self.lexicon) - 1))
        if len(self.lexicon):
            hit = self.lexicon[at] == h
            out[hit, :-1] = self.holders[at[hit]]
        out[:, -1] = out[:, :-1].sum(1) == 0
        return out

    def emissions(self, w: Words, step: int = 1 << 14) -> np.ndarray:
        """Scores (words, languages) of the words by themselves."""
        out = np.zeros((len(w.start), len(self.langs)))
        for lo in range(0, len(out), step):
            hi = min(lo + step, len(out))
            part = Words(w.data, w.bounds, w.start[lo:hi], w.end[lo:hi], w.first, w.h[lo:hi])
            out[lo:hi] = features(part).total(self.weights) + self.lexical(part.h) @ self.by_holder
        return out


# -- forward and backward ------------------------------------------------------

def marginals(emit: np.ndarray, fresh: np.ndarray, start: np.ndarray, trans: np.ndarray):
    """Probabilities (words, languages) of chains that begin where ``fresh``,
    and the sum of the probabilities of pairs of neighbours (languages,
    languages)."""
    n, k = emit.shape
    if not n:
        return emit, np.zeros((k, k))
    blocks = -(-n // BLOCK)
    pad = blocks * BLOCK - n
    top = emit.max(1, keepdims=True)
    e = np.concatenate([np.exp(emit - top), np.ones((pad, k))]).reshape(blocks, BLOCK, k).transpose(1, 0, 2).copy()
    new = np.concatenate([fresh, np.ones(pad, bool)]).reshape(blocks, BLOCK).T.copy()
    step = np.exp(trans - trans.max())
    begin = np.exp(start - start.max())

    through = np.broadcast_to(np.eye(k), (blocks, k, k)).copy()
    for i in range(BLOCK):
        nxt = through @ step
        if new[i].any():
            nxt[new[i]] = through[new[i]].sum(2, keepdims=True) * begin
        through = nxt * e[i][:, None, :]
        through /= through.max((1, 2), keepdims=True)

    ahead, behind = np.zeros((blocks, k)), np.ones((blocks, k))
    v = np.ones(k) / k
    for b in range(blocks):
        ahead[b] = v
        v = v @ through[b]
        v /= v.sum()
    v = np.ones(k)
    for b in range(blocks - 1, -1, -1):
        behind[b] = v
        v = through[b] @ v
        v /= v.max()

    alpha, beta = np.zeros_like(e), np.zeros_like(e)
    v = ahead
    for i in range(BLOCK):
        v = np.where(new[i][:, None], begin, v @ step) * e[i]
        v /= v.sum(1, keepdims=True)
        alpha[i] = v
    v = behind
    for i in range(BLOCK - 1, -1, -1):
        beta[i] = v
        v = np.where(new[i][:, None], 1.0, (e[i] * v) @ step.T)
        v /= v.max(1, keepdims=True)

    def flat(x):
        return x.transpose(1, 0, 2).reshape(blocks * BLOCK, k)[:n]
    a, b, e = flat(alpha), flat(beta), flat(e)
    gamma = a * b
    gamma /= gamma.sum(1, keepdims=True)
    inner = np.flatnonzero(~fresh)
    inner = inner[inner > 0]
    left, right = a[inner - 1], (e * b)[inner]
    z = ((left @ step) * right).sum(1, keepdims=True)
    return gamma, ((left / z).T @ right) * step


# -- fitting -----------------------------------------------------------------------

def sample_texts(docs: DataFrame, sample: int, span: int) -> list[tuple[str, str]]:
    """At most ``sample`` rows (lang, up to ``span`` characters) a language,
    in the order of a hash of the row."""
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
                       F.xxhash64(F.col("doc_id"), F.col("text")).alias("h")) \
               .filter("lang is not null and text rlike '\\\\p{L}'")
    counts = rows.groupBy("lang").count()
    # rows are thinned by hash before the window, which then holds a few
    # times ``sample`` rows of a language however many there are
    places = 1 << 30
    thin = rows.join(F.broadcast(counts), "lang") \
               .filter(F.pmod("h", F.lit(places)) / F.lit(places) <= F.lit(4.0 * sample) / F.col("count"))
    room = F.greatest(F.length("text") - span + 1, F.lit(1))
    piece = F.substring(F.col("text"), (F.pmod(F.xxhash64("h"), room) + 1).cast("int"), F.lit(span))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    first = thin.select("lang", "h", piece.alias("text")).withColumn("k", order)
    return sorted((r["lang"], r["text"]) for r in first.filter(F.col("k") <= sample).select("lang", "text").collect())


def _join(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "replace") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def lexicon_of(h: np.ndarray, doc: np.ndarray, lang: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that at least HOLDERS texts of a language have."""
    order = np.lexsort((doc, h))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    words, which = np.unique(h[new], return_inverse=True)
    n = np.zeros((len(words), k), np.int64)
    np.add.at(n, (which, lang[doc[new]]), 1)
    holds = n >= HOLDERS
    some = holds.any(1)
    return words[some], holds[some].astype(np.float32)


def fit_texts(texts: list[tuple[str, str]]) -> Model:
    """The model of (lang, text) rows."""
    langs = sorted({x for x, _ in texts})
    k = len(langs)
    data, bounds = _join([t for _, t in texts])
    w = words_of(data, bounds)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(w.first))
    lang = np.array([langs.index(x) for x, _ in texts], np.int64)
    lexicon, holders = lexicon_of(w.h, doc, lang, k)
    model = Model(langs, np.zeros((ROWS, k), np.float32), lexicon, holders, np.zeros((k + 1, k), np.float32),
                  np.zeros(k), np.zeros((k, k)))
    if k < 2 or not len(w.start):
        return model
    lexical = model.lexical(w.h)
    label = lang[doc]
    rng = np.random.default_rng(1)
    params = [model.weights, model.by_holder, model.start, model.trans]
    seen = [np.full_like(p, 1e-8) for p in params]
    for _ in range(EPOCHS):
        # spans of 4 to 60 words; two to six of them, of any language, make a chain
        cuts = np.unique(np.concatenate([w.first, np.cumsum(rng.integers(4, 61, len(doc) // 4 + 1))]))
        cuts = cuts[cuts <= len(doc)]
        lo, hi = cuts[:-1], cuts[1:]
        order = rng.permutation(len(lo))
        lo, hi = lo[order], hi[order]
        chain = np.repeat(np.arange(len(lo)), rng.integers(2, 7, len(lo)))[:len(lo)]
        begins = np.concatenate([[True], chain[1:] != chain[:-1]])
        batch = np.cumsum(hi - lo) // BATCH
        for b in range(int(batch[-1]) + 1 if len(batch) else 0):
            mine = np.flatnonzero(batch == b)
            if not len(mine):
                continue
            n = hi[mine] - lo[mine]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo[mine], n)
            fresh = np.zeros(len(at), bool)
            heads = np.cumsum(n) - n
            fresh[heads[begins[mine]]] = True
            fresh[0] = True
            # made anew for each batch: memory follows BATCH, not the sample
            f = features(Words(w.data, w.bounds, w.start[at], w.end[at], w.first, w.h[at]))
            emit = f.total(model.weights) + lexical[at] @ model.by_holder
            gamma, pairs = marginals(emit.astype(np.float64), fresh, model.start, model.trans)
            y = label[at]
            wrong = gamma.copy()
            wrong[np.arange(len(at)), y] -= 1
            inner = np.flatnonzero(~fresh)
            np.subtract.at(pairs, (y[inner - 1], y[inner]), 1)
            row, word = f.flat()
            g = [np.stack([np.bincount(row, wrong[word, j], ROWS) for j in range(k)], 1), lexical[at].T @ wrong,
                 wrong[fresh].sum(0), pairs]
            for p, s, grad in zip(params, seen, g):
                grad = grad / len(at) * 100
                if p is not model.weights:
                    grad = grad + DECAY * p
                s += grad ** 2
                p -= RATE * grad / np.sqrt(s)
    return model


def fit(docs: DataFrame, sample: int = SAMPLE, span: int = SPAN) -> Model:
    """The model of the rows of ``docs`` (doc_id, text, lang)."""
    return fit_texts(sample_texts(docs, sample, span))


# -- labelling ---------------------------------------------------------------------

def label_words(model: Model, w: Words) -> np.ndarray:
    """Probabilities of the languages (words, languages)."""
    fresh = np.zeros(len(w.start), bool)
    fresh[w.first[:-1][w.first[:-1] < len(fresh)]] = True
    return marginals(model.emissions(w), fresh, model.start, model.trans)[0]


def _label(shared):
    kind = LABELLED["spans"].dataType.elementType
    struct = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])

    def group(model: Model, data: np.ndarray, bounds: np.ndarray, has: np.ndarray):
        n = len(bounds) - 1
        langs = np.array([*model.langs, UNKNOWN], object)
        w = words_of(data, bounds)
        n_words = np.diff(w.first)
        known = has & (n_words > 0) & bool(model.langs)
        p = label_words(model, w) if model.langs else np.zeros((len(w.start), 1))
        doc = np.repeat(np.arange(n), n_words)
        sums = np.stack([np.bincount(doc, p[:, j], n) for j in range(p.shape[1])], 1)
        best = np.where(known, sums.argmax(1), len(langs) - 1)
        # rounded: the last bits depend on how texts fell into blocks
        score = np.round(np.where(known, sums.max(1) / np.maximum(n_words, 1), 0.0).clip(0, 1), 9)
        # runs of one label inside a text
        label = p.argmax(1)
        keep = known[doc]
        label, doc, start, end = label[keep], doc[keep], w.start[keep], w.end[keep]
        turn = np.ones(len(doc), bool)
        turn[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(turn)
        tail = np.append(head[1:], len(doc))[:len(head)] - 1
        index = ExceptionIndex(data)
        base = index.to_char(bounds)[:-1][doc[head]]
        spans = pa.StructArray.from_arrays(
            [pa.array(index.to_char(start[head]) - base), pa.array(index.to_char(end[tail]) - base),
             pa.array(langs[label[head]].tolist(), pa.string())], fields=list(struct))
        off = np.searchsorted(doc[head], np.arange(n + 1)).astype(np.int32)
        return [pa.array(langs[best].tolist(), pa.string()), pa.array(score), pa.ListArray.from_arrays(pa.array(off), spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        assert kind.fieldNames() == [f.name for f in struct]
        for batch in batches:
            off, data = text_column(batch, "text")
            has = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for d, e in groups(off):
                cols = group(model, data[off[d]:off[e]], off[d:e + 1] - off[d], has[d:e])
                yield pa.RecordBatch.from_arrays([batch.column(0)[d:e], *cols], names=LABELLED.fieldNames())
    return run


def label(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, and the
    spans (start, end in code points, lang) of words of one language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.coalesce(text.rlike("\\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(_label(shared), LABELLED)
