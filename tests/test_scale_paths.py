"""The plans a cluster runs on big batches and big tables, checked on the
real tables: probe broadcasts off (probe limit 0) and automatic broadcast
off, so every join is a shuffled one.  Results must equal the oracle."""

import pytest

from tests.conftest import SF01
from tests.oracle_compare import compare

AFFECTED = ["upsert_products", "add_customers", "customers_after_add", "accept_orders",
            "customer_orders", "order_lines", "call_get_orders", "trigger_audit",
            "trigger_add_customers"]


@pytest.fixture(scope="module")
def shuffled(spark):
    from stockroom.plans import queries
    conf = {"spark.stockroom.probe.maxRows": "0", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    queries._TRIGGER_RUNS.clear()
    yield spark
    queries._TRIGGER_RUNS.clear()
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", AFFECTED)
def test_shuffled_plan_matches_oracle(shuffled, name):
    ok, msg = compare(shuffled, name, SF01)
    assert ok, msg


def test_the_shuffled_path_is_taken(shuffled):
    import contextlib
    import io

    from stockroom.plans.queries import QUERIES
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES["accept_orders"](shuffled, SF01).explain()
    text = buf.getvalue()
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
