"""What a fetch brought: union over sort passes, what is exported, what it cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_passes(passes: DataFrame, rows: DataFrame, max_comments: int = 0) -> tuple[DataFrame, DataFrame]:
    """Comments that a walk over sort passes collects, each once, and for each post calls, collected and truncated.

    passes: post_id, pass_no from 1, has_data, meta_truncated (null if not said),
    expected (null or 0: unknown). rows: post_id, pass_no, seq, comment_id, ... The
    walk ends after the pass that reaches the cap or what is expected, says that
    nothing is missing, or, unless it is the first, adds nothing; a pass without
    data is only a call.
    """
    named = rows.filter(F.coalesce("comment_id", F.lit("")) != "")
    first = named.withColumn("__n", F.row_number().over(Window.partitionBy("post_id", "comment_id").orderBy("pass_no", "seq"))).filter("__n = 1").drop("__n")
    added = first.groupBy("post_id", "pass_no").agg(F.count("*").alias("added"))
    order = Window.partitionBy("post_id").orderBy("pass_no")
    walked = passes.join(added, ["post_id", "pass_no"], "left").fillna(0, ["added"])
    walked = walked.withColumn("upto", F.sum("added").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    expected = F.coalesce("expected", F.lit(0))
    ends = (F.lit(max_comments) > 0) & (F.col("upto") >= max_comments) | (F.coalesce("meta_truncated", F.lit(True)) == F.lit(False)) | (expected > 0) & (F.col("upto") >= expected) | (F.col("added") == 0) & (F.col("pass_no") > 1)
    walked = walked.withColumn("stop", F.min(F.when(F.col("has_data") & ends, F.col("pass_no"))).over(Window.partitionBy("post_id")))
    walked = walked.filter(F.col("stop").isNull() | (F.col("pass_no") <= F.col("stop")))
    said = F.max_by("meta_truncated", F.when(F.col("has_data"), F.col("pass_no")))
    told = walked.groupBy("post_id").agg(F.count("*").alias("calls"), F.max("upto").alias("collected"), said.alias("said"), F.max("expected").alias("expected"))
    short = (F.coalesce("expected", F.lit(0)) > 0) & (F.col("collected") < F.col("expected"))
    facts = told.select("post_id", "calls", (F.least("collected", F.lit(max_comments)) if max_comments else F.col("collected")).alias("collected"), F.when(F.col("said") == F.lit(False), F.lit(False)).otherwise(short).alias("truncated"))
    kept = first.join(walked.select("post_id", "pass_no"), ["post_id", "pass_no"], "left_semi")
    kept = kept.withColumn("visit", F.row_number().over(Window.partitionBy("post_id").orderBy("pass_no", "seq")))
    return (kept.filter(F.col("visit") <= max_comments) if max_comments else kept), facts


def exported(rows: DataFrame, known: DataFrame, every: bool, key: str = "comment_id", order: str | Column = "seq") -> DataFrame:
    """Rows that a run exports, each id once and the first counts, with is_new: new ones, or with `every` (repair, no deduplication) all."""
    order = F.col(order) if isinstance(order, str) else order
    named = rows.filter(F.coalesce(key, F.lit("")) != "")
    first = named.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order))).filter("__n = 1").drop("__n")
    seen = known.select(F.col(key).alias("__known")).distinct()
    marked = first.join(seen, F.col(key) == F.col("__known"), "left").withColumn("is_new", F.col("__known").isNull()).drop("__known")
    return marked if every else marked.filter("is_new")


def counters(items: DataFrame) -> DataFrame:
    """One row of what a run did: posts by way, calls and credits, posts skipped for want of budget, comments new and refreshed.

    items: route (cheap, full), skipped, calls, credits, new_comments, refreshed_comments.
    """
    done = ~F.coalesce("skipped", F.lit(False))
    total = lambda c, when=done: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))
    return items.agg(
        F.count_if(done).alias("posts"), F.count_if(done & (F.col("route") == "cheap")).alias("posts_cheap"), F.count_if(done & (F.col("route") == "full")).alias("posts_full"), F.count_if(~done).alias("posts_skipped"),
        total("calls", done & (F.col("route") == "cheap")).alias("calls_cheap"), total("calls", done & (F.col("route") == "full")).alias("calls_full"), total("credits").alias("credits"),
        total("new_comments").alias("new_comments"), total("refreshed_comments").alias("refreshed_comments"),
    )
