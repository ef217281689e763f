"""Session helpers of the reference operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir, or under the warehouse where the session names none, as in local tests."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """df from files in the shared folder of spark.checkpoint.dir, so that its lineage ends there.

    Only where the session names no folder, as in local tests, one under the warehouse is set.
    """
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.conf.set("spark.checkpoint.dir", base)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return df.checkpoint()
