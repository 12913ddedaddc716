"""Fill-in-middle against plain string slicing."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from stockroom.llm import infill, queries
from tests.conftest import SF001

CHARS = ["a", "b", " ", "\n", "\n", "é", "日", "😀", "\r", "\0", "<", "P", ">", " "]


def corpus():
    r = random.Random(3)
    texts = [None, "", "\n", "\n\n\n", "a", "é", "😀\n", "no line feed", "has <M> inside\nb", "<<P>", "a<\n<S\n>b\n",
             "日本\n語\n" * 4000, "x" * 300000, "copy\nof\nrow", "copy\nof\nrow"]
    texts += ["".join(r.choice(CHARS) for _ in range(r.randrange(1, 60))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(None, "null id\nline\n"), (13, "copy\nof\nrow"), (-5, "negative\nid")]


def expected(doc_id, text, unit, rate=100, spm=50, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "lines" else list(text)
    n = len(units)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return n, "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


@pytest.fixture(scope="module")
def docs(spark):
    # names of the operator's own columns among the others
    return spark.createDataFrame([(i, t, "f", 1, "o") for i, t in corpus()],
                                 "doc_id long, text string, form string, n int, output string").repartition(3)


@pytest.mark.parametrize("unit,rate,spm", [("lines", 100, 50), ("characters", 100, 50), ("lines", 40, 90)])
def test_matches_string_slicing(docs, unit, rate, spm):
    out = infill.transform(docs, unit, rate, spm).withColumn("again", infill.restore("output", "form"))
    got = sorted((str(r.doc_id), (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.again) for r in out.collect())
    assert got == sorted((str(i), expected(i, t, unit, rate, spm), t or "") for i, t in corpus())


def test_index_turns_cuts_both_ways():
    for text in ["", "ascii only", "é", "a日b😀é" * 50]:
        raw = text.encode()
        index = infill.ExceptionIndex(np.frombuffer(raw, np.uint8))
        chars = np.arange(len(text) + 1)
        at = np.array([len(text[:k].encode()) for k in chars])
        assert (index.to_byte(chars) == at).all() and (index.to_char(at) == chars).all()
        assert len(index.byte) == sum(ord(c) > 127 for c in text)


def test_empty_table_and_bad_arguments(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert infill.transform(docs).count() == 0
    with pytest.raises(ValueError):
        infill.transform(docs, unit="words")
    with pytest.raises(ValueError):
        infill.transform(docs, sentinels=("<A>", "<A>", "<B>"))


def test_query_gives_the_digests(spark):
    rows = {r.doc_id: r for r in queries.op11_infill(spark, SF001).collect()}
    docs = queries.table(spark, SF001, "documents").select("doc_id", "text").collect()
    assert len(rows) == len(docs)

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()
    for d in docs:
        n, form, prefix, middle, output = expected(d.doc_id, d.text, "lines")
        assert tuple(rows[d.doc_id]) == (d.doc_id, n, form, prefix, middle, sha(output), sha(d.text))


def test_query_is_one_pass(spark):
    plan = queries.op11_infill(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
