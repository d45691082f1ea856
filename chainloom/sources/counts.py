"""Row counts and extremes of stored tables out of the footers of their files: no page of data is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def footer_session(spark: SparkSession) -> SparkSession:
    """A session whose Parquet scans answer counts and extremes of whole tables by their files' statistics."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")  # the reader that takes aggregates over
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def footer_counts(spark: SparkSession, tables: dict[str, tuple[str, str]]) -> DataFrame:
    """name, rows, smallest and largest of tables {name: (path, integer column)}. Works with columns of whole numbers,
    whose statistics are exact; an empty table has no rows and null extremes."""
    session, out = footer_session(spark), None
    for name, (path, column) in tables.items():
        one = session.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.min(column).alias("smallest"), F.max(column).alias("largest"))
        # the sum of no files' counts is null, though a count's type says that it never is
        one = one.select(F.lit(name).alias("name"), F.coalesce(F.nullif("rows", F.lit(-1).cast("long")), F.lit(0).cast("long")).alias("rows"), F.col("smallest").cast("long").alias("smallest"), F.col("largest").cast("long").alias("largest"))
        out = one if out is None else out.unionByName(one)
    return out
