"""Incremental state: upserts, inserts, run ledger. Parquet has no MERGE, so tables are rewritten as new versions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert_rows(base: DataFrame, incoming: DataFrame, key: str, seq: str) -> DataFrame:
    """Whole rows replaced by key; of equal incoming keys the last wins; blank keys go.

    The column `place` orders the result: rows of the base as they were, new keys
    behind them in order of arrival.
    """
    columns = [c for c in base.columns if c != seq]
    both = base.select(*columns, F.lit(0).alias("__new"), F.col(seq).cast("bigint").alias("__seq")).unionByName(incoming.select(*columns, F.lit(1).alias("__new"), F.col(seq).cast("bigint").alias("__seq")))
    both = both.filter(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "")
    order = F.struct("__new", "__seq")
    rest = [c for c in columns if c != key]
    merged = both.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__row"), F.min(order).alias("place"))
    return merged.select(key, *[F.col("__row")[c].alias(c) for c in rest], "place")


def upsert_keeping_first(base: DataFrame, incoming: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """State rows: values of the newest sighting, `first` of the oldest."""
    both = base.unionByName(incoming).filter(F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != "")
    rest = [c for c in base.columns if c not in (key, first)]
    merged = both.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(last, *[c for c in rest if c != last])).alias("__row"), F.min(first).alias(first))
    return merged.select(key, first, *[F.col("__row")[c].alias(c) for c in rest])


def insert_only(base: DataFrame, incoming: DataFrame, key: str, seq: str) -> DataFrame:
    """Incoming rows whose key is new, the first of each; what an append adds."""
    fresh = incoming.join(base.select(F.col(key).alias("__known")).distinct(), F.col(key) == F.col("__known"), "left_anti")
    return fresh.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(seq))).filter("__n = 1").drop("__n")


def new_and_refreshed(incoming: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row: distinct incoming keys that are new, and those that were known."""
    keys = incoming.select(key).distinct()
    marked = keys.join(known.select(F.col(key).alias("__known")).distinct(), F.col(key) == F.col("__known"), "left")
    return marked.agg(F.count_if(F.col("__known").isNull()).alias("new_count"), F.count_if(F.col("__known").isNotNull()).alias("refreshed_count"))


def run_view(events: DataFrame) -> DataFrame:
    """The latest state of every run; a run still `running` when a later one starts was interrupted.

    events: run_id, seq, status and counters, append-only.
    """
    latest = events.groupBy("run_id").agg(F.max_by(F.struct("status", "post_count", "new_comment_count"), "seq").alias("s"), F.min("seq").alias("started"), F.max("seq").alias("updated"))
    after = latest.agg(F.max("started").alias("newest"))
    status = F.when((F.col("s.status") == "running") & (F.col("started") < F.col("newest")), "interrupted").otherwise(F.col("s.status"))
    # one row joins: the newest start
    return latest.crossJoin(F.broadcast(after)).select("run_id", status.alias("status"), "s.post_count", "s.new_comment_count", "started", "updated")


def lookup_posts(state: DataFrame, wanted: DataFrame, key: str = "post_id") -> DataFrame:
    """State rows of the wanted ids, by the id itself or with its kind prefix, the exact form first."""
    ids = wanted.select(F.col(key).alias("wanted")).distinct()
    forms = ids.select("wanted", F.explode(F.array(F.struct(F.col("wanted").alias("form"), F.lit(0).alias("rank")), F.struct(F.concat(F.lit("t3_"), "wanted").alias("form"), F.lit(1).alias("rank")))).alias("f")).select("wanted", "f.*")
    found = forms.join(state, F.col("form") == F.col(key))
    return found.withColumn("__n", F.row_number().over(Window.partitionBy("wanted").orderBy("rank"))).filter("__n = 1").drop("__n", "form", "rank")


def import_ids(state: DataFrame, ids: DataFrame, now: str, key: str = "comment_id", first: str = "first_seen_at") -> DataFrame:
    """state with the ids of an older ledger that it does not have yet, seen `now`; other columns are null."""
    old = ids.select(F.trim(key).alias(key)).filter(F.col(key) != "").distinct().join(state.select(key), key, "left_anti")
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in state.schema.fields if f.name not in (key, first)]
    return state.unionByName(old.select(key, F.lit(now).cast(state.schema[first].dataType).alias(first), *blank))


def start_run(events: DataFrame, run_id: str, seq: int, at: str) -> DataFrame:
    """events with the start of a run; run_view() takes it that a run still open is interrupted by that."""
    return _event(events, run_id, seq, "running", 0, 0, at)


def progress(events: DataFrame, run_id: str, seq: int, posts: int, comments: int, at: str) -> DataFrame:
    return _event(events, run_id, seq, "running", posts, comments, at)


def finish_run(events: DataFrame, run_id: str, seq: int, posts: int, comments: int, at: str, failures: int = 0, error: str | None = None) -> DataFrame:
    """The end of a run: failed with an error, else completed, with or without failures."""
    return _event(events, run_id, seq, "failed" if error else "completed_with_errors" if failures else "completed", posts, comments, at)


def _event(events: DataFrame, *values) -> DataFrame:
    return events.unionByName(events.sparkSession.createDataFrame([values], "run_id string, seq long, status string, post_count int, new_comment_count int, at string"), allowMissingColumns=True)


def _pointers(spark, folder: str):
    """The file system, the folder and the numbers of its pointer files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [str(f.getPath().getName()) for f in fs.listStatus(at)] if fs.exists(at) else []
    return fs, at, sorted(int(n[8:]) for n in names if n.startswith("pointer-") and n[8:].isdigit())


def write_version(df: DataFrame, folder: str, version: str) -> str:
    """Writes a whole new version of a table, then a new pointer file to it.

    Pointers are numbered and never replaced: a reader takes the highest one, so it
    finds the old version or the new one at any time, and a crash between leaves the
    old one. Two writers at once: the second to rename fails.
    """
    path = f"{folder}/v={version}"
    df.write.mode("overwrite").parquet(path)
    point_to(df.sparkSession, folder, version)
    return path


def point_to(spark, folder: str, version: str) -> None:
    """The pointer file of a version that is there."""
    fs, at, numbers = _pointers(spark, folder)
    new = spark._jvm.org.apache.hadoop.fs.Path
    target = new(at, f"pointer-{(numbers[-1] if numbers else 0) + 1:012d}")
    part = new(at, f".part-{uuid.uuid4().hex}")
    out = fs.create(part, False)
    out.write(bytearray(version.encode()))
    out.close()
    if fs.exists(target) or not fs.rename(part, target):
        fs.delete(part, False)
        raise RuntimeError(f"another writer has moved the pointer of {folder}")


def current_version(spark, folder: str) -> str | None:
    """The version that the highest pointer names, or None."""
    _, _, numbers = _pointers(spark, folder)
    return spark.read.text(f"{folder}/pointer-{numbers[-1]:012d}", wholetext=True).first()[0] if numbers else None


def read_version(spark, folder: str) -> DataFrame:
    if (version := current_version(spark, folder)) is None:
        raise FileNotFoundError(f"{folder} has no version")
    return spark.read.parquet(f"{folder}/v={version}")
