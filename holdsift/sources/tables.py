"""Stored tables: Parquet folders and databases. The published table is in ``commits``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PERIOD = ["period_year", "period_month"]


def exists(spark: SparkSession, path: str) -> bool:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath)


def only_periods(published: DataFrame, periods: DataFrame) -> DataFrame:
    """Rows of the given periods; the join is on the partition columns, so Spark can skip the other partitions."""
    return published.join(periods.distinct(), PERIOD, "left_semi")


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """Warehouse table kept in a database; pass partitionColumn, lowerBound, upperBound, numPartitions for parallel reads."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
