"""SRC-09 to SRC-14: tables by name, table streams, parameters, namespaces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sparkwatch.functions.times import AsOf, as_of_bound


def use_namespace(spark: SparkSession, schema: str) -> DataFrame:
    """SRC-14: create and select a schema; returns its tables, without the session's temporary views."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    spark.catalog.setCurrentDatabase(schema)
    return spark.sql("SHOW TABLES").where(~F.col("isTemporary"))


def _is_file(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()


def table_stream(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame:
    """SRC-09: rows appended to a Parquet table, as a stream.

    A table is a folder of part files, all of which are read. A table that is
    a single file is read through its folder, which streams need.
    """
    if _is_file(spark, path):
        path, _, name = path.rstrip("/").rpartition("/")
        options["pathGlobFilter"] = name
    return spark.readStream.schema(schema).options(**options).parquet(path)


def read_since(
    source: DataFrame, target: DataFrame | None, ts: str, until: AsOf = None
) -> DataFrame:
    """SRC-12: rows newer than the newest row of ``target`` and not after ``until``.

    The mark is one value, read first so that it becomes a literal and prunes
    the source files.
    """
    out = source.where(F.col(ts) <= as_of_bound(source, ts, until))
    if target is None:
        return out
    mark = target.agg(F.max(ts).alias("mark")).first()["mark"]
    return out if mark is None else out.where(F.col(ts) > F.lit(mark).cast(source.schema[ts].dataType))


def query(spark: SparkSession, sql: str, **params) -> DataFrame:
    """SRC-13: SQL with named parameters, bound and not pasted in."""
    return spark.sql(sql, args=params)


def preview(df: DataFrame, rows: int = 3) -> DataFrame:
    """SRC-15: a few rows for a look at the data."""
    return df.limit(rows)
