"""Near duplicates between 0.80 and 0.85: the stage drops them, op3 keeps them."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest

import corpus_pipeline
from stockroom.llm import minhash_dedup


def miss(n, p, t):
    p = Fraction(str(p))
    a, b = p.numerator, p.denominator
    return float(Fraction(sum(math.comb(n, k) * a ** k * (b - a) ** (n - k) for k in range(t)), b ** n))


@pytest.mark.parametrize("percent", [70, 80, 85, 90])
def test_limits_follow_the_similarity(percent):
    lim, j = minhash_dedup.limits(percent), percent / 100
    assert miss(minhash_dedup.M, j, lim.t) <= 1.1e-5
    assert miss(minhash_dedup.LOW, (1 + j) / 2, minhash_dedup.LOW - lim.apart) <= 3.5e-6
    assert all(miss(n, j, t) <= 2e-7 or t == 1 for n, t in lim.funnel)


def test_limits_of_op3_stay():
    lim = minhash_dedup.limits()
    assert (lim.percent, lim.t, lim.apart, lim.funnel) == (85, 192, 164, ((16, 5), (64, 38)))


def test_pairs_between_80_and_85(spark):
    rng = random.Random(6)
    rows, want = [], set()
    for g in range(40):
        w = [f"w{rng.randrange(10 ** 9)}" for _ in range(404)]
        edited = list(w)
        # 400 shingles; e edits far apart touch 5 each: similarity (400 - 5e) / (400 + 5e)
        e = 7 + g % 3
        for k in range(e):
            edited[20 + 40 * k] = "edited" + str(rng.randrange(10 ** 9))
        j = (400 - 5 * e) / (400 + 5 * e)
        assert 0.79 < j < 0.85
        rows += [(2 * g, " ".join(w)), (2 * g + 1, " ".join(edited))]
        want |= {2 * g} | ({2 * g + 1} if j < 0.8 else set())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()} == want
    assert minhash_dedup.near_duplicate_groups(docs).filter("not kept").count() == 0
