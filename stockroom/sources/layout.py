"""Bucketed storage for tables that are joined again and again.

``order_lines`` joins lineitem and orders on the order key.  Stored as
plain parquet, both sides are shuffled by that key on every query.  Stored
bucketed by the key into the same number of buckets, each bucket of one
table meets only the same bucket of the other and the join needs no
shuffle.  Writing the layout costs one shuffle per table, once.

A bucket is one task of the join, and nothing splits it: an order with a
third of all lines would make one file and one task of that size.  The
*salted* layout therefore deals the lines of such an order over several
pieces (column ``SALT``) and keeps a copy of the order for each piece; both
tables are bucketed by key and piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` bucketed and sorted by ``key`` and register
    it as table ``name``.  Repartitioning by the same key first gives one
    file per bucket (Spark's shuffle hash equals its bucket hash)."""
    (df.repartition(buckets, key)
       .write.mode("errorifexists")
       .bucketBy(buckets, key).sortBy(key)
       .option("path", path)
       .saveAsTable(name))
    return df.sparkSession.table(name)


SALT = "_piece"
PIECE_ROWS = 1_000_000   # rows of one key that stay together


def _write_salted(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    (df.repartition(buckets, key, SALT)
       .write.mode("errorifexists")
       .bucketBy(buckets, key, SALT).sortBy(key, SALT)
       .option("path", path)
       .saveAsTable(name))
    return df.sparkSession.table(name)


def write_salted(lines: DataFrame, line_key: str, heads: DataFrame, head_key: str, names: tuple[str, str],
                 path: str, buckets: int, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """Store ``lines`` and ``heads`` (one row a key, or few) for joins on
    ``line_key = head_key``, as tables ``names`` below ``path``.  Keys with
    more than ``piece_rows`` lines are cut into that many pieces; join on key
    and ``SALT`` (``views.order_lines(..., salt=SALT)``), and read the heads
    by themselves with ``SALT = 0``.

    There are at most ``rows / piece_rows`` such keys: they come from a count
    with partial aggregation, and Spark broadcasts them if they are few."""
    hot = (lines.groupBy(F.col(line_key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
           .filter((F.col("_n") > piece_rows) & F.col("_hot").isNotNull())
           .select("_hot", F.ceil(F.col("_n") / piece_rows).cast("int").alias("_pieces")))
    # a row's number deals equal rows over the pieces too
    dealt = lines.withColumn("_row", F.monotonically_increasing_id()).join(hot, F.col(line_key) == F.col("_hot"), "left")
    salted = dealt.withColumn(SALT, F.coalesce(F.pmod("_row", F.col("_pieces")), F.lit(0)).cast("int"))
    copies = heads.join(hot, F.col(head_key) == F.col("_hot"), "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)))
    return (_write_salted(salted.select(*lines.columns, SALT), names[0], f"{path}/{names[0]}", line_key, buckets),
            _write_salted(copies.select(*heads.columns, SALT), names[1], f"{path}/{names[1]}", head_key, buckets))


def open_bucketed(spark: SparkSession, name: str, path: str, schema: StructType,
                  key: str, buckets: int) -> DataFrame:
    """Register a bucketed directory written earlier (for a new session)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
              f"LOCATION '{path}'")
    return spark.table(name)
