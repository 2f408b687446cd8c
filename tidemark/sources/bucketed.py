"""Parquet folders bucketed by key.

Two folders with equal bucket counts join on the key without a shuffle. Spark
keeps the bucketing of a folder in the catalog only, so a reader declares it
again under a throw-away table name; dropping that external table leaves both
the files and the already resolved DataFrame alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace ``path`` with ``df``, bucketed and sorted by ``keys``.

    Give it a frame already hash-partitioned on the keys into ``buckets``
    partitions: each task then holds whole buckets and writes one file per
    bucket.
    """
    table = _quote(f"tidemark_{uuid.uuid4().hex}")
    spark = df.sparkSession
    try:
        (
            df.write.format("parquet")
            .mode("overwrite")
            .bucketBy(buckets, *keys)
            .sortBy(*keys)
            .option("path", path)
            .saveAsTable(table)
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def read_bucketed(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int
) -> DataFrame:
    """The folder ``path`` as a frame that knows it is bucketed."""
    table = _quote(f"tidemark_{uuid.uuid4().hex}")
    by = ", ".join(_quote(k) for k in keys)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({schema.toDDL()}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
