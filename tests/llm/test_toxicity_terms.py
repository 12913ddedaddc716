"""Terms of both classes, however small their lift, take part in the search."""

from __future__ import annotations

import random

from stockroom.llm import toxicity


def test_weak_and_clean_terms_are_searched(spark):
    r = random.Random(8)
    rows = []
    for i in range(600):
        y = int(i % 3 == 0)
        # 'grumble' is three times as frequent in toxic texts, 'pleasant' marks clean ones
        t = ["filler"] + ["grumble"] * (r.random() < (0.9 if y else 0.3)) + ["pleasant"] * (not y and r.random() < 0.7)
        rows.append((i, " ".join(t), y))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, "pleasant filler"), (1001, "grumble filler")],
                                 "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert "=grumble" in model.idf and "=pleasant" in model.idf
    got = {x.doc_id: x for x in toxicity.score(docs.filter("doc_id >= 1000"), model).collect()}
    assert len(got[1000].evidence) == len(got[1001].evidence) == toxicity.NEIGHBOURS
    assert got[1000].score < toxicity.THRESHOLD <= got[1001].score
