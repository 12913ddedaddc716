"""O3 upsert: hand-made rows on both plan paths."""

import pytest

from stockroom.operators.products import upsert_products
from stockroom.schemas import PART

SEQ = PART.simpleString()[len("struct<"):-1].replace(":", " ") + ", seq long"


@pytest.mark.parametrize("probe", [2_000_000, 0])
def test_actions_and_values(spark, probe):
    current = spark.createDataFrame([
        (1, "a", "B1", "T", 1, 10.0),
        (2, "b", None, "T", 1, 10.0),     # null attribute, unchanged by a null
        (3, "c", "B1", "T", 1, 10.0),     # null attribute arriving -> updated
        (4, "d", "B1", "T", 1, 10.0),     # kept
        (None, "nk", "B1", "T", 1, 1.0),  # current row without key stays
    ], PART)
    batch = spark.createDataFrame([
        (1, "a", "B1", "T", 1, 11.0),     # updated
        (2, "b", None, "T", 1, 10.0),     # unchanged (null = null)
        (3, "c", None, "T", 1, 10.0),     # updated
        (9, "z", "B9", "T", 9, 99.0),     # inserted
        (None, "bad", "B", "T", 1, 1.0),  # rejected
    ], PART)
    out = upsert_products(current, batch, probe_max_rows=probe)
    got = {r["p_partkey"]: (r["action"], r["p_retailprice"], r["p_brand"]) for r in out.collect()
           if r["p_partkey"] is not None}
    assert got == {1: ("updated", 11.0, "B1"), 2: ("unchanged", 10.0, None),
                   3: ("updated", 10.0, None), 4: ("kept", 10.0, "B1"),
                   9: ("inserted", 99.0, "B9")}
    nulls = sorted(r["action"] for r in out.collect() if r["p_partkey"] is None)
    assert nulls == ["kept", "rejected"]


def test_seq_dedupes_batch(spark):
    current = spark.createDataFrame([(1, "a", "B1", "T", 1, 10.0)], PART)
    batch = spark.createDataFrame([
        (1, "a", "B1", "T", 1, 12.0, 2),
        (1, "a", "B1", "T", 1, 11.0, 1),
        (5, "e", "B1", "T", 1, 5.0, 7),
        (5, "e", "B1", "T", 1, 6.0, 8),
    ], SEQ)
    out = {r["p_partkey"]: (r["action"], r["p_retailprice"])
           for r in upsert_products(current, batch, seq="seq").collect()}
    assert out == {1: ("updated", 12.0), 5: ("inserted", 6.0)}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_row = st.tuples(st.one_of(st.none(), st.integers(0, 8)),
                 st.one_of(st.none(), st.sampled_from(["a", "b"])),
                 st.one_of(st.none(), st.sampled_from([1.0, 2.0])))


def _model(current, batch):
    """Brute force: merge row by row."""
    cur = {k: (n, p) for k, n, p in current if k is not None}
    new = {k: (n, p) for k, n, p in batch if k is not None}
    out = []
    for k in cur.keys() | new.keys():
        if k not in cur:
            out.append((k, *new[k], "inserted"))
        elif k not in new:
            out.append((k, *cur[k], "kept"))
        else:
            out.append((k, *new[k], "unchanged" if cur[k] == new[k] else "updated"))
    out += [(None, n, p, "kept") for k, n, p in current if k is None]
    out += [(None, n, p, "rejected") for k, n, p in batch if k is None]
    return sorted(out, key=repr)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(_row, max_size=12, unique_by=lambda r: r[0] if r[0] is not None else object()),
       st.lists(_row, max_size=12, unique_by=lambda r: r[0] if r[0] is not None else object()),
       st.booleans())
def test_matches_brute_force(spark, current, batch, small):
    def df(rows):
        return spark.createDataFrame([(k, n, "B", "T", 1, p) for k, n, p in rows], PART)
    out = upsert_products(df(current), df(batch), probe_max_rows=2_000_000 if small else 0)
    got = sorted(((r["p_partkey"], r["p_name"], r["p_retailprice"], r["action"])
                  for r in out.collect()), key=repr)
    assert got == _model(current, batch)


def test_seq_null_keeps_a_row(spark):
    current = spark.createDataFrame([(1, "a", "B1", "T", 1, 10.0)], PART)
    batch = spark.createDataFrame([
        (1, "a", "B1", "T", 1, 12.0, None),
        (1, "a", "B1", "T", 1, 11.0, 3),
        (7, "g", "B1", "T", 1, 7.0, None),
    ], SEQ)
    out = {r["p_partkey"]: (r["action"], r["p_retailprice"])
           for r in upsert_products(current, batch, seq="seq").collect()}
    assert out == {1: ("updated", 11.0), 7: ("inserted", 7.0)}
