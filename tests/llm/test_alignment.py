"""Alignment of two tokenizers against whole-text encoding in plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest

from stockroom.llm import alignment, queries
from stockroom.llm.kernels import stash
from tests.conftest import SF001

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
CHARS = ["a", "the", " ", "  ", "\n", "\t", "\r\n", "é", "日本", "😀", "\0", "1", "23", ".", "...", "'s", "　", "\xa0", "\x1c",
         "\x85", "​", "ing", "<s>", "<|endoftext|>", "é", "Ω", "ﬁ", "\x0b", "_", "--"]


def corpus():
    r = random.Random(11)
    texts = [None, "", " ", "\n", "plain words here", "plain words here", "a literal ▁ mark", "  leading", "trailing  \n ", "ends in a space ",
             "x" * 5000, "日本" * 900, "word " * 4000, "<|endoftext|> and </s>", "tab\tand\n\n \nlines", "　 \nwide"]
    texts += ["".join(r.choice(CHARS) for _ in range(r.randrange(1, 40))) for _ in range(400)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, "null id here"), (4, "plain words here")]


def brute(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    sp = SentencePieceProcessor(model_file=B)
    to_byte = alignment.byte_level_bytes()
    names = {i: t for t, i in ta.get_vocab().items()}

    def piece_b(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()
    out, held = [], Counter()
    for i, t in rows:
        a = ta.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        pa, pb = [bytes(to_byte[c] for c in names[x]) for x in a], [piece_b(x) for x in b]
        if not t or not (b"".join(pa) == b"".join(pb) == (" " + t).encode()):
            out.append((i, [], [], []))
            continue

        def ends(parts):
            at, e = 0, []
            for p in parts:
                at += len(p)
                e.append(at)
            return e
        ea, eb = ends(pa), ends(pb)
        groups, x, y = [], 0, 0
        for end in sorted(set(ea) & set(eb)):
            u, v = ea.index(end, x) + 1, eb.index(end, y) + 1
            groups.append((a[x:u], b[y:v]))
            x, y = u, v
        links = [(p, q) for g, h in groups for p in g for q in h]
        held.update(set(links))
        out.append((i, a, b, groups))
    top = defaultdict(int)
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    res = []
    for i, a, b, groups in out:
        links = [(p, q) for g, h in groups for p in g for q in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        res.append((i, len(a), len(b), len(groups), len(links), sum(held[x] == top[x[0]] for x in links),
                    sum(held[x] for x in links), text))
    return res


def key(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("common", [alignment.COMMON, 50, 0])
def test_matches_whole_text_encoding(spark, monkeypatch, common):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 5, "g") for i, t in rows], "doc_id long, text string, rid int, groups string").repartition(4)
    kept = stash(alignment.align(docs, A, B), "test")
    got = kept.join(alignment.score_links(kept, common), "rid")
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in got.collect()]
    assert key(got) == key(brute(rows))


def test_products_in_slices_give_the_same_links():
    import numpy as np
    import pyarrow as pa
    r = np.random.default_rng(2)
    ends_a, ends_b = np.array([40, 41, 300]), np.array([60, 70, 333])
    a = alignment.of_groups(pa.chunked_array([r.integers(0, 30, 300).astype(np.int32)]), ends_a)
    b = alignment.of_groups(pa.chunked_array([r.integers(0, 30, 333).astype(np.int32)]), ends_b)
    doc = np.array([0, 0, 1])
    whole = alignment.links_of(a, b, doc).sort_by([("doc", "ascending"), ("pair", "ascending")])
    size, alignment.SLICE = alignment.SLICE, 7
    try:
        cut = alignment.links_of(a, b, doc).sort_by([("doc", "ascending"), ("pair", "ascending")])
    finally:
        alignment.SLICE = size
    assert whole.equals(cut) and sum(whole["n"].to_pylist()) == 40 * 60 + 10 + 259 * 263


def test_cache_of_a_warm_worker_changes_nothing():
    warm = alignment.Encoders(A, B)
    rows = [t.encode() for _, t in corpus() if t]

    def ids(text):
        place = warm.learn(warm.chunks(text))
        return warm.lists_a.take(place).to_pylist(), warm.lists_b.take(place).to_pylist()
    first = [ids(t) for t in rows]
    assert [ids(t) for t in rows[::-1]] == first[::-1]
    warm.bytes = alignment.CACHE_BYTES + 1
    assert ids(rows[3]) == first[3] and len(warm.place) < 10


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    kept = stash(alignment.align(docs, A, B), "test")
    assert kept.join(alignment.score_links(kept), "rid").count() == 0


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF001, "documents").collect()]
    want = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "") for r in brute(docs)]
    assert key(tuple(r) for r in queries.op13_alignment(spark, SF001).collect()) == key(want)
