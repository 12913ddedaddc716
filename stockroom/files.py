"""Small file-system checks through Hadoop's FileSystem (any scheme the
cluster supports: file, hdfs, s3a, ...)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path`` (empty if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory and what is in it."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file as a whole."""
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small UTF-8 file that must not exist yet."""
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file unless ``target`` exists; False if it does."""
    jvm = spark.sparkContext._jvm
    fs, _ = _fs(spark, source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    if exists(spark, target):
        return False
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target), options)
    except Exception as e:                       # lost the race for the name
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True


def sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of each Parquet file below ``path``, by its path."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return {}
    out, listed = {}, fs.listFiles(p, True)
    while listed.hasNext():
        s = listed.next()
        if s.getPath().getName().endswith(".parquet"):
            out[s.getPath().toString()] = s.getLen()
    return out
