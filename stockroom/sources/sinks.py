"""Parquet sink for derived tables.

Spark cannot overwrite a path it is reading in the same job: the files are
deleted before they are read and the table is left empty.  A new version of
a table therefore always goes to a new directory: ``write_table`` refuses
an existing target unless rows are appended to it, however its path is
spelled, so no source can be destroyed and no input files are listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockroom import files


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: list[str] | None = None) -> None:
    if mode != "append" and files.exists(df.sparkSession, path):
        raise ValueError(f"refusing to overwrite {path}: write the new version to a new directory")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
