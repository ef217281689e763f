"""What the training-data operators share: scratch tables, file systems, skew-safe joins."""

from __future__ import annotations

import contextlib
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A group that holds more than 1/HOT_SHARE of all rows is hot; fewer than HOT_SHARE such groups can exist.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only where the session names none, as in local tests, a folder under the
    warehouse is taken and set for this application.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/colloquy/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends in files that every executor can reach."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(spark.read.parquet(path).schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path through Hadoop's file system API."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard_table(df: DataFrame) -> None:
    """Deletes the files of a table made by materialize()."""
    files = df.inputFiles()
    for root in {f[: f.index("/colloquy/") + 10] + f[f.index("/colloquy/") + 10 :].split("/")[0] for f in files if "/colloquy/" in f}:
        discard(df.sparkSession, root)


def filesystem(uri: str):
    """The pyarrow file system of a shared folder and the path in it (file, hdfs, s3, gs)."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


class WholeFile:
    """A file that appears under its name only when it is closed without an error."""

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.part, self.size = f"{self.path}.{uuid.uuid4().hex[:8]}.part", 0
        self.out = self.fs.open_output_stream(self.part)

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.part, self.path)


def write_whole(uri: str, parts) -> int:
    """Writes byte strings to a file that appears under its name only when complete, so that a retried task replaces it."""
    file = WholeFile(uri)
    for p in parts:
        file.write(p)
    file.close()
    return file.size


def shuffle_partitions(spark: SparkSession, total_bytes: float = 0, each: int = 64 << 20) -> int:
    """Shuffle partitions that the session asks for, or more if partitions would exceed `each` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total_bytes / each), 1)


def unused(columns: list[str], *names: str) -> list[str]:
    """Names like these that none of the columns has; Spark does not tell cases apart."""
    taken, out = {c.casefold() for c in columns}, []
    for name in names:
        while name.casefold() in taken:
            name += "_"
        taken.add(name.casefold())
        out.append(name)
    return out


def quoted(names: list[str]) -> list[Column]:
    """Columns by their exact names, dots and all."""
    return [F.col(f"`{n.replace('`', '``')}`") for n in names]


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def crc_mod(c: str | Column, n: int) -> Column:
    """crc32 of an id written as text, modulo n; a null id counts as an empty string."""
    c = F.col(c) if isinstance(c, str) else c
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def attach_groups(members: DataFrame, groups: DataFrame, key: str, size: str, total: int, salt: str) -> DataFrame:
    """members left-joined with groups (one row per key) without dealing a hot key to one task.

    Groups above total/HOT_SHARE rows number fewer than HOT_SHARE, whatever the
    input, so those rows are broadcast; their members get a salted key that
    matches nothing in the shuffled join of the rest (or, where keys are numbers, a
    value that is not read). The key is text or a long.
    """
    values = [c for c in groups.columns if c != key]
    hots, colds = ([f"{kind}{n}" for n in unused(members.columns, *[f"__{kind}_{v}" for v in values])] for kind in ("h", "c"))
    hot_key, cold_key, own = unused(members.columns, "__hot_key", "__cold_key", "__own_key")
    least = max(total // HOT_SHARE, 1)
    hot = groups.filter(F.col(size) > least).select(F.col(key).alias(hot_key), *[F.col(v).alias(n) for v, n in zip(values, hots)])
    cold = groups.filter(F.col(size) <= least).select(F.col(key).alias(cold_key), *[F.col(v).alias(n) for v, n in zip(values, colds)])
    out = members.join(F.broadcast(hot), F.col(key) == F.col(hot_key), "left")
    spread = F.xxhash64(salt) if dict(groups.dtypes)[key] == "bigint" else F.concat(F.lit("~"), F.xxhash64(salt).cast("string"))
    out = out.withColumn(own, F.when(F.col(hot_key).isNull(), F.col(key)).otherwise(spread))
    out = out.join(cold, F.col(own) == F.col(cold_key), "left")
    return out.select(*quoted(members.columns), *[F.coalesce(h, c).alias(v) for h, c, v in zip(hots, colds, values)])


@contextlib.contextmanager
def shuffles_end_with_the_query(spark: SparkSession):
    """Queries that run inside delete their shuffle files when they end, not when the driver next collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Scratch:
    """Named tables of one operator in the shared folder; those that the result does not read can be dropped early."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.paths[name] = scratch(self.spark, f"{self.name}-{name}")
        with shuffles_end_with_the_query(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for n in names:
            discard(self.spark, self.paths.pop(n))


def components(edges: DataFrame, work: Scratch, rounds: int = 40) -> DataFrame:
    """node, root (the smallest node that its edges reach) for every node of edges (a, b), by alternating large and small stars.

    Each half-round is one aggregate and one join; edges are written between
    rounds and none reaches the driver.
    """
    key = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    now = work.keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0")
    before = now.agg(F.count("*"), key).first()
    for k in range(1, rounds + 1):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = work.keep(large, f"large-{k}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        small = work.keep(small.filter("a <> b").distinct(), f"edges-{k}")
        work.drop(f"large-{k}", f"edges-{k - 1}")
        now, after = small, small.agg(F.count("*"), key).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
