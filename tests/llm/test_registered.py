"""The registered queries' contract columns against brute force on a whole small table."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from stockroom.llm import queries
from tests.conftest import SF001

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def sha(t):
    return hashlib.sha256(t if isinstance(t, bytes) else t.encode()).hexdigest()


def crc(i):
    return zlib.crc32(str(i).encode())


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in queries.table(spark, SF001, "documents").collect()}


def by_id(df):
    rows = df.collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_op1_pieces_hold_the_tokenizers_ids(spark, docs):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {}
    for i, text in docs.items():
        ids = t.encode(text, add_special_tokens=False).ids + [0]
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[i, k] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    rows = queries.op1_best_fit_packing(spark, SF001).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    seqs: dict = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in seqs.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seqs) <= math.ceil(sum(x[1] for x in want.values()) / 2048) + 2


def test_op2_columns(spark, docs):
    got = by_id(queries.op2_toxicity(spark, SF001))
    assert set(got) == set(docs)
    for i, r in got.items():
        assert r.held_out == (crc(i) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


KINDS = [("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                               re.IGNORECASE | re.ASCII), lambda m: len(m[2]) >= 12),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
         ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16)]


def test_op5_base_spans(spark, docs):
    got = by_id(queries.op5_secret_scan(spark, SF001))
    assert set(got) == set(docs)
    some = 0
    for i, text in docs.items():
        spans = sorted((m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(KINDS) for m in p.finditer(text) if ok(m))
        base = [f"{name}:{a}:{b}" for a, _, b, name in spans]
        n = Counter(x[3] for x in spans)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == (n["assign"], n["access"], n["hex"])
        assert r.base_sha256 == sha(",".join(base)) and set(base) <= set(filter(None, r.spans.split(",")))
        some += bool(base)
    assert some


def test_op6_rewrites_only_its_spans_and_alike_everywhere(spark, docs):
    got = by_id(queries.op6_pii(spark, SF001))
    assert set(got) == set(docs) and any(r.n_found for r in got.values())
    same: dict = {}
    for i, text in docs.items():
        r = got[i]
        spans = [(k, int(a), int(b)) for k, a, b in (x.split(":") for x in filter(None, r.spans.split(",")))]
        assert len(spans) == r.n_found
        # between the spans nothing changes; the spans give way to others of their kind
        at, parts = 0, []
        for _, a, b in spans:
            parts.append(re.escape(text[at:a]))
            at = b
        m = re.fullmatch("(.+?)".join([*parts, re.escape(text[at:])]), r.text or "", re.DOTALL)
        assert m, i
        for (kind, a, b), new in zip(spans, m.groups()):
            old = text[a:b]
            same.setdefault((kind, old), set()).add(new)
            if kind in ("card", "iban", "date", "phone", "ssn"):
                assert [c.isdigit() for c in old] == [c.isdigit() for c in new]
    assert all(len(v) == 1 for v in same.values())       # equal values stay linked across documents


def test_op8_digests(spark, docs):
    import base64

    import tiktoken
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_id(queries.op8_byte_bpe(spark, SF001))
    for i, text in docs.items():
        ids = enc.encode_ordinary(text)
        assert tuple(got[i]) == (i, len(ids), sha(",".join(map(str, ids))), sha(enc.decode_bytes(ids)))


def test_op9_edits_and_likeness(spark, docs):
    got = by_id(queries.op9_fingerprints(spark, SF001))
    order = sorted(docs, reverse=True)
    for i, j in zip(order, order[1:] + order[:1]):
        text, n, r = docs[i], len(docs[i]), got[i]
        half = n // 2
        edited = text[:n - half] + docs[j][:half] if half else text
        assert (r.n_chars, r.edited_sha256) == (n, sha(edited))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == text:
            assert r.fingerprint == r.edited_fingerprint and r.near_edited == 1


def test_op10_base_columns(spark, docs):
    tokens = {i: WORD.findall(t.translate(UPPER)) + [None] for i, t in docs.items()}
    c = Counter(w for i, ws in tokens.items() if crc(i) % 10 for w in ws)
    total, distinct = sum(c.values()), len(c)
    got = by_id(queries.op10_mixing_lm(spark, SF001))
    assert set(got) == set(docs)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(i) % 10 == 0, len(ws), sum(c[w] > 0 for w in ws), total)
        base = sum(math.log10((c[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in ws)
        assert abs(r.base_score - base) <= 1e-6 * abs(base) and r.score < 0
