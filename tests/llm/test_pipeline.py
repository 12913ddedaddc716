"""The corpus pipeline on whole small tables, stage by stage."""

from __future__ import annotations

import random
import re

import corpus_pipeline
from stockroom.llm.kernels import stash
from tests.conftest import SF01


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stash(stage(spark, docs, SF01), "test")
        assert after.columns == columns and after.schema == docs.schema
        n = after.count()
        assert n < rows if name in ("toxicity", "near_duplicates") else n == rows
        docs, rows = after, n
    assert docs.filter("text rlike 'AKIA[A-Z0-9]{14,}'").count() == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF01)
    assert packed.select("doc_id").distinct().count() == rows


def _brute(rows):
    """Stages two to four of (doc_id, text) rows in plain Python, on sets of word tuples."""
    word = re.compile(r"[^\x20\x09-\x0D]+")
    upper = {c: c + 32 for c in range(65, 91)}

    def shingles(t):
        w = word.findall((t or "").translate(upper))
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    ids = sorted({i for i, _ in rows if i is not None})
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, s in sets:
        for b, u in sets:
            both = len(s & u)
            if a != b and both and 100 * both >= 80 * (len(s) + len(u) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    has = {i for i, s in sets if s}
    rows = [(i, t) for i, t in rows if i is None or top(i) == i or i not in has]

    first: dict = {}
    for i, t in rows:
        w = word.findall(t or "")
        for k in range(len(w) - 49):
            if i is not None:
                first[tuple(w[k:k + 50])] = min(i, first.get(tuple(w[k:k + 50]), i))
    cut = []
    for i, t in rows:
        w = word.findall(t or "")
        gone = set()
        for k in range(len(w) - 49):
            if i is not None and first[tuple(w[k:k + 50])] < i:
                gone.update(range(k, k + 50))
        cut.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    return rows, cut


def test_stages_equal_brute_force_on_nulls_and_repeats(spark, tmp_path):
    r = random.Random(2)

    def words(n):
        return [f"w{r.randrange(10 ** 5)}" for _ in range(n)]
    base, passage = words(100), words(60)
    near = base[:97] + words(2)
    far = base[:50] + words(60)
    texts = [(1, None), (2, ""), (3, " ".join(base)), (4, " ".join(near)), (5, " ".join(base)), (5, " ".join(base)),
             (6, " ".join(far)), (7, " ".join(words(30) + passage + words(5))), (8, " ".join(words(9) + passage)),
             (9, " ".join(words(20)) + " password = Abcdefgh12345678 end"), (10, "one two"), (11, "one two"), (None, " ".join(base)),
             (None, None), (12, " \n "), (13, " ".join(passage)), (14, "x " * 200)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in texts], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (3, 1, 0), (None, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    def rows(df):
        return sorted(((x.doc_id, x.text) for x in df.collect()), key=str)
    stages = dict(corpus_pipeline.STAGES)
    one = stages["toxicity"](spark, docs, str(tmp_path))
    assert rows(one) == sorted(texts, key=str)              # no toxic example: nobody is rejected
    kept, cut = _brute(texts)
    two = stash(stages["near_duplicates"](spark, one, str(tmp_path)), "test")
    assert rows(two) == sorted(kept, key=str)
    three = stash(stages["repeated_passages"](spark, two, str(tmp_path)), "test")
    assert rows(three) == sorted(cut, key=str)
    assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in three.collect())
    four = stash(stages["secrets"](spark, three, str(tmp_path)), "test")
    assert [(i, t) for i, t in rows(four) if "[SECRET]" in (t or "")] == \
        [(9, dict(cut)[9].replace("password = Abcdefgh12345678", "[SECRET]"))]
    assert four.schema == docs.schema and four.count() == len(cut)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(packed) == len(cut)
    ends: dict = {}
    for x in sorted(packed, key=lambda x: x.offset):
        assert x.offset == ends.get(x.sequence_id, 0)
        ends[x.sequence_id] = x.offset + x.length
    assert max(ends.values()) <= 2048 and len(ends) == -(-sum(ends.values()) // 2048)


def test_pipeline_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
