"""The sink never replaces a table, however its path is spelled."""

import os

import pytest

from stockroom.session import scratch_dir
from stockroom.sources.sinks import write_table


@pytest.mark.parametrize("spelling", ["plain", "uri", "relative", "dots"])
def test_overwrite_of_an_existing_table_is_refused(spark, spelling):
    path = scratch_dir(spark, "test sinks").removeprefix("file://").removeprefix("file:") + "/a table"
    write_table(spark.range(5), path, mode="overwrite")       # nothing there yet
    df = spark.read.parquet(path)
    target = {"plain": path, "uri": f"file://{path}", "relative": os.path.relpath(path),
              "dots": f"{os.path.dirname(path)}/x/../a table"}[spelling]
    with pytest.raises(ValueError, match="refusing"):
        write_table(df, target, mode="overwrite")
    assert spark.read.parquet(path).count() == 5
