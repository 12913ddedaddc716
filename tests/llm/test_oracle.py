"""Registered queries of the subpackage against their DuckDB SQL."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from stockroom.llm.queries import ORACLE, QUERIES
from tests.conftest import SF001
from tests.oracle_compare import _rows, spark_rows


def duck_rows(sf_dir, sql):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name):
    s, s_cols = _rows(*spark_rows(QUERIES[name](spark, SF001)))
    d, d_cols = _rows(*duck_rows(SF001, ORACLE[name]))
    assert s_cols == d_cols and len(s) == len(d)
    assert Counter(s) == Counter(d)
