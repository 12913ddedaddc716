"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_mod


def test_entry_runs_the_flagship(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority"]
    assert df.count() == 4            # customer 7, 1996-1997, sf0.001 (FIXTURES.md §3)


def test_queries_and_oracles_pair_up():
    from stockroom.plans.queries import ORACLE, QUERIES
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(q) and set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and "SELECT" in s.upper() for s in o.values())


def test_core_queries_stay_if_the_subpackage_cannot_be_imported(tmp_path):
    """A library that only the training-data queries need is missing."""
    import subprocess
    import sys
    from pathlib import Path
    code = ("import sys; sys.modules['public_tokenizers'] = None; sys.modules['stockroom.llm.kernels'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(entry_mod.__file__).parent)
    from stockroom.plans.queries import QUERIES
    assert out.stdout.split() == [str(len(QUERIES))] * 2 and "left out" in out.stderr
