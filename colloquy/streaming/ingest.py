"""Continuous ingest: landed candidate files in micro-batches."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.discover import keep_first


def ingest(spark: SparkSession, landing: str, schema: StructType, table: str, checkpoint: str, key: str = "post_id", seq: str = "created_utc", max_files: int = 100) -> StreamingQuery:
    """Appends rows whose key the table does not hold yet, a micro-batch at a time; stops when the landing folder is read.

    A batch writes to a folder of its checkpoint and number, so that one which runs
    again after a failure replaces what it wrote, and a new checkpoint on an old
    table overwrites nothing. It compares with all other folders, the first batch
    too; only their keys are read, and only the batch's own are kept of them.
    """

    def write(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        stream = json.loads(s.read.text(f"{checkpoint}/metadata").first()[0])["id"].replace("-", "")
        fresh = keep_first(batch.filter(f"coalesce({key}, '') <> ''"), key, seq)
        try:
            known = s.read.schema(f"{key} string, stream string, batch long").parquet(table).filter((F.col("stream") != stream) | (F.col("batch") < number))
            hits = known.select(key).join(fresh.select(key), key, "left_semi").distinct()
            fresh = fresh.join(hits, key, "left_anti")
        except AnalysisException as error:  # the first batch of all, or those before were empty
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        fresh.write.mode("overwrite").parquet(f"{table}/stream={stream}/batch={number}")

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(landing)
    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
