"""Parquet table access (S-09 schema read-back included).

Tables are read lazily; callers select the columns they need so Catalyst
prunes the Parquet ``ReadSchema`` and pushes filters into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None, spread_out: bool = False) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    return spread(df) if spread_out else df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin rows over the cluster when a scan is narrower than it.

    For CPU-heavy per-row work (regex parsing, tokenising long texts).  A
    large input already scans as one task per row group, so this adds no
    shuffle there; only under-split input (one row group, a gzip file) is
    redistributed.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD access (Spark Connect): leave the scan as it is
        return df
    return df if have >= want else df.repartition(want)


def declared_table(spark: SparkSession, schema, rows=()) -> DataFrame:
    """A table with a declared schema, empty or with a few literal rows (S-05, S-08).

    For model-sized or parameter-sized tables only; data never goes this way.
    """
    return spark.createDataFrame(list(rows), schema)


def schema_table(df: DataFrame) -> DataFrame:
    """Column names and types of ``df`` as a DataFrame (S-09)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")
