"""Repeated ids, warm caches, hashes that are chosen to collide, and clashing
column names."""

from __future__ import annotations

import random
from array import array

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from stockroom.llm import forest_search, kernels, minhash_dedup, packing, secret_scan, substring_dedup, toxicity


def test_packing_ids_do_not_depend_on_what_was_encoded_before():
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    r = random.Random(6)
    pieces = ["<", ">", "]", "--", ".", ",", "...", "a", "the", "é", "É", "日本", "'s", "7", "&", "ﬁ", "A.", "<.", "β", "ß,"]
    texts = ["< <.", "> >,", "] ].", "-- --.", "<. <", ", ,. .", "a a. a, A."]
    texts += [" ".join("".join(r.choice(pieces) for _ in range(r.randrange(1, 4))) for _ in range(6)) for _ in range(3000)]
    for order in (texts, texts[::-1]):
        warm = packing.ChunkEncoder(path)
        for t in order:
            want = array("I", whole.encode(t, add_special_tokens=False).ids).tobytes()
            assert warm.encode(t.encode()) == want, t


def test_links_of_every_text_of_an_id_count(spark):
    def words(seed):
        r = random.Random(seed)
        return [f"w{r.randrange(10 ** 6)}" for _ in range(120)]
    a, b = words(1), words(2)
    near_a, near_b = a[:115] + words(3)[:2], b[:116] + words(4)[:2]
    rows = [(5, a), (5, b), (6, near_a), (7, near_b), (8, words(9)), (9, b), (9, words(9)), (5, a)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows] + [(5, ""), (None, " ".join(a))], "doc_id long, text string")
    got = minhash_dedup.near_duplicate_groups(docs).collect()
    assert len(got) == 10
    comp = {(r.doc_id, r.n_shingles > 0): r.component_id for r in got}
    assert comp == {(5, True): 5, (5, False): 5, (6, True): 5, (7, True): 5, (8, True): 5, (9, True): 5, (None, True): None}
    kept = minhash_dedup.drop_near_duplicates(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 5)] * 4 + [(True, 0)]


def test_component_is_the_smallest_id_also_if_classes_share_it(spark):
    r = random.Random(8)
    texts = [" ".join(f"v{r.randrange(10 ** 6)}" for _ in range(40)) for _ in range(6)]
    rows = [(3, texts[0]), (3, texts[1]), (2, texts[1]), (4, texts[0]), (3, texts[2]), (10, texts[2]), (11, texts[3]), (1, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in minhash_dedup.near_duplicate_groups(docs).collect()}
    assert got == {3: 2, 2: 2, 4: 2, 10: 2, 11: 1, 1: 1}


def test_each_query_row_gets_its_own_neighbours(spark):
    r = np.random.default_rng(0)
    rows = [(i, r.normal(size=8).tolist()) for i in range(40)] + [(0, r.normal(size=8).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = df.filter("vec_id = 0")
    got = [x for x in forest_search.nearest(df, asked).collect()]
    assert sorted(x["rank"] for x in got) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    data = np.array([v for _, v in rows])
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    want = []
    for q in (0, 40):
        cos = unit @ unit[q]
        order = [k for k in np.argsort(-cos) if rows[k][0] != 0][:5]
        want += [(rows[k][0], round(float(cos[k]), 9)) for k in order]
    assert sorted((x["vec_id"], round(x["score"], 9)) for x in got) == sorted(want)


def test_examples_stay_bounded_when_ids_repeat(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TOXIC_EXAMPLES", 30)
    monkeypatch.setattr(toxicity, "CLEAN_EXAMPLES", 40)
    docs = spark.range(4000).select((F.col("id") % 100).alias("doc_id"),
                                    F.concat(F.when(F.col("id") % 2 == 0, F.lit("vile ")).otherwise(F.lit("kind ")), F.col("id").cast("string")).alias("text"))
    labels = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("toxic"))
    model = toxicity.fit(docs, labels)
    assert sum(model.labels) == 30 and len(model.labels) == 70 and len(set(model.ids)) == 70


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_chosen_to_collide_stay_apart(spark):
    one = thue_morse(1024)
    two = one.translate(str.maketrans("ab", "ba"))
    raw = np.frombuffer(f"{one} {two}".encode(), np.uint8)
    w = kernels.split_words(raw, np.array([0, len(raw)]), False)
    assert w.h[0] != w.h[1] and w.hash(kernels.RW2)[0] != w.hash(kernels.RW2)[1]
    other = [f"x{i}" for i in range(49)]
    docs = spark.createDataFrame([(1, " ".join([one, *other])), (2, " ".join([two, *other])), (3, " ".join([two, *other, "end"]))],
                                 "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == {1: 0, 2: 0, 3: 50}


@pytest.mark.parametrize("names", [["_gone", "_id", "_th", "_cuts", "_starts", "_score"],
                                   ["gone", "id_of_cuts", "th_of_cuts", "cuts", "starts", "score"],
                                   ["Gone", "th_of_starts", "id_of_starts", "_evidence", "evidence", "predicted"]])
def test_clashing_names_come_through(spark, names):
    text = "shared words of a passage " * 20
    rows = [(1, text + "password = abcdefghijklmnop12", *range(6)), (2, text + "password = abcdefghijklmnop12", *range(6, 12)),
            (3, "alone here", *range(12, 18)), (4, None, *range(18, 24))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))

    def others(df):
        return sorted(tuple(r[n] for n in ["doc_id", *names]) for r in df.collect())
    want = others(docs)
    near = minhash_dedup.drop_near_duplicates(docs)
    assert near.columns == docs.columns and others(near) == [want[0], *want[2:]]
    red = secret_scan.redact(docs)
    assert red.columns == docs.columns and others(red) == want
    assert red.filter("text like '%abcdefghijklmnop12%'").count() == 0
    cut = substring_dedup.remove_repeats(docs)
    assert others(cut) == want and cut.columns == [*docs.columns, "n_words", "n_removed", "kept_text"]
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and set(others(left)) <= set(want)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash_dedup.near_duplicate_groups(docs).count() == 0
    assert secret_scan.redact(docs).count() == 0 and substring_dedup.remove_repeats(docs).count() == 0
    assert toxicity.drop_toxic(docs, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0
