"""Repair lists: which posts to fetch again, and what the state knows of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import BLANK


def targets(lines: DataFrame, keep_case: bool = False, line: str = "line", seq: str = "seq") -> DataFrame:
    """seq, post_id, given (a whole URL or null) and error for every line that is neither blank nor a comment."""
    text = F.regexp_replace(F.coalesce(line, F.lit("")), f"^(?:\\ufeff|{BLANK})+|{BLANK}+$", "")
    found = U.repair_target(text, keep_case)
    rows = lines.select(F.col(seq).alias("seq"), text.alias("text")).filter((F.col("text") != "") & ~F.col("text").startswith("#"))
    found = U.repair_target("text", keep_case)
    error = F.when(found.isNull(), F.concat(F.lit("line "), F.col("seq").cast("string"), F.lit(": no post id in "), "text"))
    return rows.select("seq", found.alias("post_id"), F.when(F.col("text").rlike("^https?://"), F.col("text")).alias("given"), error.alias("error"))


def once(rows: DataFrame) -> DataFrame:
    """Targets without errors, each post once: the place of its first line, the payload of its last."""
    good = rows.filter("error is null")
    return good.groupBy("post_id").agg(F.min("seq").alias("seq"), F.max_by("given", F.col("seq")).alias("given")).select("seq", "post_id", "given")


def resolve(wanted: DataFrame, state: DataFrame) -> DataFrame:
    """Targets (seq, post_id, given) with what the state knows of them; of several state rows of a post the latest, the exact form of the id first.

    The link is the given URL, else the stored one, else one made from the id; the
    community may come from the link.
    """
    columns = ("permalink", "subreddit", "title", "source_type", "matched_keyword", "reported_comment_count", "last_scraped_at")
    have = [F.col(c) if c in state.columns else F.lit(None).cast("string").alias(c) for c in columns]
    known = state.select(F.regexp_replace(F.lower("post_id"), "^t3_", "").alias("k"), F.col("post_id").alias("stored"), *have)
    exact = (F.lower("stored") == F.col("k")).cast("int")
    known = known.groupBy("k").agg(F.max_by(F.struct("stored", *columns), F.struct(exact, F.coalesce("last_scraped_at", F.lit("")), "stored")).alias("s")).select("k", "s.*")
    joined = wanted.join(known, F.lower("post_id") == F.col("k"), "left")
    made = F.concat(F.lit(f"https://{U.MODERN_HOST}/comments/"), "post_id", F.lit("/"))
    link = F.coalesce("given", F.when(F.coalesce("permalink", F.lit("")) != "", F.col("permalink")), made)
    name = F.when(F.coalesce("subreddit", F.lit("")) != "", F.col("subreddit")).otherwise(U.community(link))
    return joined.select(
        "seq", F.coalesce("stored", "post_id").alias("post_id"), link.alias("permalink"), name.alias("subreddit"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("title", "matched_keyword")],
        F.coalesce(F.when(F.col("source_type") != "", F.col("source_type")), F.lit("repair")).alias("source_type"), F.col("reported_comment_count").cast("int").alias("num_comments"), F.lit("repair").alias("intake_mode"),
    )
