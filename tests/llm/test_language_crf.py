"""Languages: the chain against plain forward-backward, spans of code-switched
texts, and accuracy on rows that were not learned from."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from stockroom.llm import language_crf as crf
from stockroom.llm import queries
from tests.conftest import SF01


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def rows(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    return crf.fit(docs.filter("crc32(cast(doc_id as string)) % 4 <> 2"))


def plain_marginals(emit, start, trans):
    """One chain, word by word, in logarithms."""
    n, k = emit.shape
    a, b = np.zeros((n, k)), np.zeros((n, k))
    a[0] = start + emit[0]
    for t in range(1, n):
        a[t] = np.logaddexp.reduce(a[t - 1][:, None] + trans, 0) + emit[t]
    for t in range(n - 2, -1, -1):
        b[t] = np.logaddexp.reduce(trans + emit[t + 1] + b[t + 1], 1)
    z = np.logaddexp.reduce(a[-1])
    pairs = np.zeros((k, k))
    for t in range(1, n):
        pairs += np.exp(a[t - 1][:, None] + trans + emit[t] + b[t] - z)
    return np.exp(a + b - z), pairs


@pytest.mark.parametrize("k", [1, 2, 5])
def test_blocks_equal_plain_forward_backward(k):
    r = np.random.default_rng(k)
    sizes = [1, 1, 3, crf.BLOCK - 5, crf.BLOCK, 1, 3 * crf.BLOCK + 7, 2]
    start, trans = r.normal(size=k), r.normal(size=(k, k)) * 2
    emit = r.normal(size=(sum(sizes), k)) * 4
    emit[5] = [50.0] + [-50.0] * (k - 1)
    fresh = np.zeros(len(emit), bool)
    fresh[np.cumsum(sizes) - sizes] = True
    gamma, pairs = crf.marginals(emit, fresh, start, trans)
    at, total = 0, np.zeros((k, k))
    for n in sizes:
        want, p = plain_marginals(emit[at:at + n], start, trans)
        assert np.allclose(gamma[at:at + n], want, atol=1e-9)
        total += p
        at += n
    assert np.allclose(pairs, total)


def test_features_are_affixes_and_grams():
    text = "ab Éclair été"
    raw = np.frombuffer(text.encode(), np.uint8)
    w = crf.words_of(raw, np.array([0, len(raw)]))
    words = [bytes(w.data[s:e]).decode() for s, e in zip(w.start, w.end)]
    assert words == ["ab", "éclair", "été"]
    row, word = crf.features(w).flat()
    want = []
    for text in (x.encode() for x in words):
        m = len(text)
        want.append(sum(max(0, m - g + 1) for g in crf.GRAMS) + sum(m >= g for g in crf.PREFIXES) + sum(m >= g for g in crf.SUFFIXES))
    assert np.bincount(word).tolist() == want and row.min() > 0
    same = crf.features(crf.words_of(raw[:2], np.array([0, 2])))
    assert sorted(same.flat()[0]) == sorted(row[word == 0])
    weights = np.random.default_rng(0).normal(size=(crf.ROWS, 3))
    weights[0] = 0
    total = crf.features(w).total(weights)
    assert np.allclose(total, [weights[row[word == i]].sum(0) for i in range(3)])


def test_held_out_accuracy(spark, rows, model):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows if held(i)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in crf.label(docs, model).collect()}
    right = [got[i] == x for i, _, x in rows if held(i)]
    assert len(right) > 200 and np.mean(right) >= 0.96
    assert (np.diag(model.trans) > model.trans.max(1, where=~np.eye(len(model.langs), dtype=bool), initial=-9)).all()


def test_spans_of_code_switched_texts(spark, rows, model):
    r = random.Random(4)
    per_lang = {x: [t for i, t, y in rows if held(i) and y == x and len(t) > 400] for x in model.langs}
    made = []
    for i in range(40):
        parts = []
        for _ in range(3):
            x = r.choice([y for y in model.langs if not parts or y != parts[-1][0]])
            words = [w for w in r.choice(per_lang[x]).split() if w.isalpha()][:25]
            parts.append((x, " ".join(words)))
        made.append((i, parts))
    docs = spark.createDataFrame([(i, " ".join(t for _, t in p)) for i, p in made], "doc_id long, text string")
    got = {x.doc_id: x for x in crf.label(docs, model).collect()}
    right = total = 0
    for i, parts in made:
        at, truth = 0, []
        for x, t in parts:
            truth += [(at + m, x) for m, c in enumerate(t) if c != " "]
            at += len(t) + 1
        said = {}
        for s in got[i].spans:
            said.update(dict.fromkeys(range(s.start, s.end), s.lang))
        right += sum(said.get(p) == x for p, x in truth)
        total += len(truth)
    assert right / total >= 0.9


def test_defined_cases(spark, model):
    texts = [None, "", " \n", "123 !!", "😀 —", "日本語", "the of and", "the of and", "word " * 60000]
    rows = [(i, t, "x", 2.0) for i, t in enumerate(texts)] + [(None, "the of and", "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string, score double")
    got = {r.doc_id: r for r in crf.label(docs, model).collect()}
    assert len(got) == len(rows)
    for i in range(5):
        assert (got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, [])
    for i in (5, 6, 7, 8, None):
        assert got[i].lang_pred in model.langs and 0 < got[i].score <= 1 and got[i].spans
    assert got[6][1:] == got[7][1:] == got[None][1:] and got[8].spans[-1].end == 60000 * 5 - 1
    assert crf.label(docs.limit(0), model).count() == 0


def test_no_labels_and_one_language(spark):
    docs = spark.createDataFrame([(1, "abc def", None), (2, None, "en")], "doc_id long, text string, lang string")
    none = crf.fit(docs)
    assert {r.lang_pred for r in crf.label(docs, none).collect()} == {"und"}
    one = crf.fit(docs.unionByName(spark.createDataFrame([(3, "abc", "xx")], docs.schema)))
    got = {r.doc_id: (r.lang_pred, r.score) for r in crf.label(docs, one).collect()}
    assert got == {1: ("xx", 1.0), 2: ("und", 0.0)}


def test_sample_is_bounded_and_covers_all_languages(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = crf.sample_texts(docs, 20, 300)
    assert {x: sum(y == x for y, _ in got) for x in {y for y, _ in got}} == {x: 20 for x in {y for *_, y in rows}}
    assert max(len(t) for _, t in got) <= 300


def test_query_learns_nothing_from_held_out_rows(spark, tmp_path, rows):
    changed = [(i, t, "zz" if held(i) else x) for i, t, x in rows]
    spark.createDataFrame(changed, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    a = {r.doc_id: tuple(r) for r in queries.op12_language_crf(spark, SF01).collect()}
    b = {r.doc_id: tuple(r) for r in queries.op12_language_crf(spark, str(tmp_path)).collect()}
    assert a == b and len(a) == len(rows) and all(r[1] == held(i) for i, r in a.items())
