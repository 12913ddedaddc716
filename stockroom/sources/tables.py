"""O1: the warehouse database as DataFrames with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockroom.schemas import SCHEMAS


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table, read with its fixed schema.  Nothing is scanned here:
    filters and projections applied later are pushed into the parquet scan."""
    return spark.read.schema(SCHEMAS[name]).parquet(table_path(sf_dir, name))


def load(spark: SparkSession, sf_dir: str, register: bool = True, prefix: str = "") -> dict[str, DataFrame]:
    """All warehouse tables; registered as temp views (their names behind
    ``prefix``) when ``register``."""
    tables = {name: read_table(spark, sf_dir, name) for name in SCHEMAS}
    if register:
        for name, df in tables.items():
            df.createOrReplaceTempView(prefix + name)
    return tables
