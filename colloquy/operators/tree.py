"""Comment trees: ancestors, context and inferred parents."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Joins that stay in one plan; deeper threads are cut every so many.
ROUNDS_IN_PLAN = 3


def ancestors(comments: DataFrame, thread: str = "thread_id", node: str = "comment_id", parent: str = "parent_id", post: str = "post_id", longest: int | None = None) -> DataFrame:
    """thread, node and ancestors (root first) for every comment.

    The walk goes up until the parent is blank, the post, missing, or met before;
    the start itself may be met once. Paths are doubled, so a thread of n
    comments takes at most log2(n) joins on (thread, node), and no more than a few
    beyond the log of its depth; a large thread is spread over all tasks. A path
    that meets a node twice is in a cycle and ends.
    longest: comments of the largest thread; counted if not given.
    """
    rows = comments.select(F.col(thread).alias("t"), F.col(node).alias("n"), F.col(parent).alias("p"), F.col(post).alias("post"))
    if longest is None:
        longest = rows.groupBy("t").count().agg(F.max("count")).first()[0] or 1
    known = rows.select(F.col("t").alias("kt"), F.col("n").alias("kn"))
    up = (F.col("kt") == F.col("t")) & (F.col("kn") == F.col("p")) & (F.col("p") != F.col("post")) & (F.col("p") != "")
    step = rows.join(known, up, "left").select("t", "n", F.col("kn").alias("jump"), F.when(F.col("kn").isNull(), F.array().cast("array<string>")).otherwise(F.array("kn")).alias("path"))
    for k in range(1, max(longest - 1, 1).bit_length() + 1):
        far = step.select(F.col("t").alias("ft"), F.col("n").alias("fn"), F.col("jump").alias("fj"), F.col("path").alias("fp"))
        joined = step.join(far, (F.col("ft") == F.col("t")) & (F.col("fn") == F.col("jump")), "left")
        path = F.when(F.col("fn").isNull(), F.col("path")).otherwise(F.concat("path", "fp"))
        joined = joined.select("t", "n", F.col("fj").alias("jump"), path.alias("whole")).withColumn("path", F.array_distinct("whole"))
        step = joined.select("t", "n", F.when(F.size("path") == F.size("whole"), F.col("jump")).alias("jump"), "path")
        if k % ROUNDS_IN_PLAN == 0:
            step = cut(step)
            if step.filter("jump is not null").isEmpty():  # no walk goes on: the depth of the trees counts, not their size
                break
    return step.select(F.col("t").alias(thread), F.col("n").alias(node), F.reverse("path").alias("ancestors"))


def enrich_context(comments: DataFrame, limit: int = 8, thread: str = "thread_id", post: str = "post_id", longest: int | None = None) -> DataFrame:
    """comments with depth, root_comment_id, ancestor_ids, parent_body and context_text rebuilt from the tree.

    context_text holds the nearest `limit` ancestors as "author: body" lines. A
    comment whose parent is missing keeps its declared depth and is its own root.
    """
    found = ancestors(comments, thread, "comment_id", "parent_id", post, longest)
    base = comments.drop("root_comment_id", "ancestor_ids", "parent_body", "context_text").withColumnRenamed("depth", "declared").join(found, [thread, "comment_id"])
    bodies = comments.select(F.col(thread).alias("bt"), F.col("comment_id").alias("bc"), F.col("body").alias("parent_text"))
    base = base.join(bodies, (F.col("bt") == F.col(thread)) & (F.col("bc") == F.col("parent_id")), "left").drop("bt", "bc")
    near = F.slice("ancestors", F.greatest(F.lit(1), F.size("ancestors") - limit + 1), limit) if limit else F.array().cast("array<string>")
    lines = base.select(F.col(thread).alias("lt"), F.col("comment_id").alias("lc"), F.posexplode(near).alias("place", "ancestor"))
    speech = comments.select(F.col(thread).alias("st"), F.col("comment_id").alias("sc"), F.concat_ws(": ", "author", "body").alias("line"))
    lines = lines.join(speech, (F.col("st") == F.col("lt")) & (F.col("sc") == F.col("ancestor")))
    # at most `limit` lines a comment
    told = lines.groupBy("lt", "lc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), "\n").alias("context_text"))
    out = base.join(told, (F.col("lt") == F.col(thread)) & (F.col("lc") == F.col("comment_id")), "left").drop("lt", "lc")
    depth = F.when(F.size("ancestors") > 0, F.size("ancestors")).when(F.col("parent_id") == F.col(post), 0).otherwise(F.col("declared"))
    return out.withColumns({
        "depth": depth.cast("int"),
        "root_comment_id": F.coalesce(F.try_element_at("ancestors", F.lit(1)), F.col("comment_id")),
        "ancestor_ids": F.array_join("ancestors", ">"),
        "parent_body": F.coalesce("parent_text", F.lit("")),
        "context_text": F.coalesce("context_text", F.lit("")),
    }).drop("ancestors", "declared", "parent_text")


#: Levels whose latest rows a window can hold at once; deeper trees pass in order through a worker.
LEVELS_IN_WINDOW = 64


def depth_stack_parents(rows: DataFrame, thread: str = "thread_id", seq: str = "seq", node: str = "comment_id", depth: str = "depth", post: str = "post_id") -> DataFrame:
    """thread, node and parent_id inferred from document order and depth alone.

    The parent is the latest row one level up that no shallower row has closed;
    depth 0 hangs on the post; a skipped level gives an empty parent. So of the
    latest rows on each shallower level the last must be on the level above.
    """
    held = rows.select(F.col(thread).alias("t"), F.col(seq).cast("long").alias("s"), F.col(node).alias("n"), F.greatest(F.col(depth).cast("int"), F.lit(0)).alias("d"), F.col(post).alias("post"))
    deepest = held.agg(F.max("d")).first()[0] or 0
    if deepest >= LEVELS_IN_WINDOW:
        return _stack_in_order(held, thread, node)
    before = Window.partitionBy("t").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    latest = F.array(*[F.max(F.when(F.col("d") == k, F.struct("s", "n"))).over(before) for k in range(deepest)]) if deepest else F.lit(None).cast("array<struct<s:bigint,n:string>>")
    told = held.withColumn("latest", latest).withColumn("above", F.try_element_at("latest", F.greatest(F.col("d"), F.lit(1))))
    last = F.array_max(F.slice("latest", 1, F.greatest(F.col("d"), F.lit(1))))
    parent = F.when(F.col("d") == 0, F.col("post")).when(F.col("above") == last, F.col("above.n")).otherwise("")
    return told.select(F.col("t").alias(thread), F.col("n").alias(node), parent.alias("parent_id"))


def _stack_in_order(held: DataFrame, thread: str, node: str) -> DataFrame:
    """Rows pass in order, with no more state than the open branch."""

    def run(batches: Iterator):
        import pyarrow as pa

        thread_now, branch = None, []  # (depth, node), ever deeper
        for batch in batches:
            parents = []
            for t, n, d, p in zip(*[batch.column(c).to_pylist() for c in ("t", "n", "d", "post")]):
                if t != thread_now:
                    thread_now, branch = t, []
                while branch and branch[-1][0] >= d:
                    branch.pop()
                parents.append(p if d == 0 else branch[-1][1] if branch and branch[-1][0] == d - 1 else "")
                branch.append((d, n))
            yield pa.RecordBatch.from_arrays([batch.column("t"), batch.column("n"), pa.array(parents, pa.string())], [thread, node, "parent_id"])

    return held.repartition("t").sortWithinPartitions("t", "s").mapInArrow(run, f"{thread} string, {node} string, parent_id string")
