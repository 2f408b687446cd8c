"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, or under the warehouse
    where that is unset: folders that the driver and all executors share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
