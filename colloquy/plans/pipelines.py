"""Whole flows over landed data: an incremental run, a run over pages, and classification with comparison."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import to_iso
from ..operators import classify, compare, discover, fetch, repair, state, tree
from ..session import cut
from ..sources import html, jsontree


@dataclass
class Options:
    """Defaults of the code; shipped configuration files differ in places."""

    days: int = 0
    zero_days_is_unlimited: bool = True
    min_comments: int = 0
    max_posts: int = 0
    max_comments: int = 0
    max_pages: int = 20
    literal_match: bool = True
    keywords: list[str] = field(default_factory=list)
    normalized_ids: bool = True
    ancestor_limit: int = 8
    include_deleted: bool = False
    dry_run: bool = False


def new_posts(candidates: DataFrame, known: DataFrame, now: float, options: Options) -> DataFrame:
    """Candidates that are recent, discussed, matched, new and within their source's cap, in this order.

    candidates: post_id, source, seq, title, num_comments, created_utc, ...
    """
    rows = candidates.filter(discover.recent("created_utc", discover.cutoff(now, options.days, options.zero_days_is_unlimited))).filter(discover.at_least("num_comments", options.min_comments))
    if options.keywords and options.literal_match:
        hits = discover.match_keywords(rows.select("post_id", "title"), options.keywords)
        rows = rows.drop("matched_keyword").join(discover.keyword_first(hits, "post_id"), "post_id")
    rows = discover.keep_first(rows, ["source", "post_id"], "seq")
    return discover.new_capped(rows, known, "post_id", "source", ["seq"], options.max_posts, options.normalized_ids)


def incremental_run(candidates: DataFrame, pages: DataFrame, known_posts: DataFrame, known_comments: DataFrame, now: float, options: Options) -> dict[str, DataFrame]:
    """posts and comments that a run adds, from candidates and landed JSON pages (thread_id, cursor, payload).

    A dry run stops after the posts. Posts are anti-joined before their trees are
    opened, as that is the dear part.
    """
    posts = cut(new_posts(candidates, known_posts, now, options))
    if options.dry_run:
        return {"posts": posts}
    wanted = pages.join(posts.select(F.col("post_id").alias("thread_id")).distinct(), "thread_id", "left_semi")
    found = jsontree.assemble(wanted, max_comments=options.max_comments, max_pages=options.max_pages)
    first = discover.keep_first(found.withColumn("order", F.struct("thread_id", "visit")), "comment_id", "order").drop("order")
    fresh = first.join(known_comments.select(F.col("comment_id").alias("k")).distinct(), F.col("comment_id") == F.col("k"), "left_anti")
    return {"posts": posts, "comments": fresh, "counts": state.new_and_refreshed(first, known_comments, "comment_id")}


def repair_run(targets: DataFrame, state_posts: DataFrame, pages: DataFrame, known_comments: DataFrame, options: Options) -> dict[str, DataFrame]:
    """posts, comments (new and refreshed, with is_new) and errors of a repair: no discovery, no cap, only the targets' trees are opened.

    targets: seq, line. A target with an error is left out and reported.
    """
    lines = repair.targets(targets)
    posts = cut(repair.resolve(repair.once(lines), state_posts))
    wanted = posts.select(F.regexp_replace(F.lower("post_id"), "^t3_", "").alias("thread_id")).distinct()
    found = jsontree.assemble(pages.join(wanted, "thread_id", "left_semi"), max_comments=options.max_comments, max_pages=options.max_pages)
    comments = fetch.exported(found, known_comments, every=True, order=F.struct("thread_id", "visit"))
    return {"posts": posts, "comments": comments, "errors": lines.filter("error is not null").select("seq", "error"), "counts": state.new_and_refreshed(comments, known_comments, "comment_id")}


def discovery_run(listings: DataFrame, searches: DataFrame, known: DataFrame, now: float, options: Options) -> DataFrame:
    """New candidates of all sources, each post once, from landed listings (source, source_no, page_no, seq, post_id, ...) and searches (also kw_seq, keyword)."""
    cutoff = discover.cutoff(now, options.days, options.zero_days_is_unlimited)
    full = discover.walk_listing(listings, cutoff, options.max_pages).withColumn("matched_keyword", F.lit(""))
    found = discover.walk_searches(searches, cutoff, options.max_pages)
    columns = [c for c in full.columns if c in found.columns]
    rows = full.select(*columns).unionByName(found.select(*columns)).filter(discover.at_least("num_comments", options.min_comments))
    rows = discover.new_capped(rows, known, "post_id", "source", ["page_no", "seq"], options.max_posts, options.normalized_ids)
    return discover.merge_sources(rows, order="source_no")


def thread_pages(posts: DataFrame, pages: DataFrame, max_continue: int = 0) -> DataFrame:
    """post_id, page_no (from 0, first come first served) and html of a thread's first page (url null) and of those that continue it.

    A page counts once; max_continue caps the pages after the first, 0 is no cap.
    """
    landed = pages.select("post_id", "url", "html")
    level = landed.join(posts.select("post_id").distinct(), "post_id", "left_semi").filter("url is null").select("post_id", F.lit("").alias("url"), F.lit("").alias("place"), "html")
    reached = level
    longest = landed.groupBy("post_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(min(longest, max_continue + 1 if max_continue else longest)):
        links = html.continuations(level, ["post_id", "place"])
        links = links.withColumn("place", F.concat_ws("/", "place", F.lpad(F.col("seq").cast("string"), 9, "0"))).groupBy("post_id", "url").agg(F.min("place").alias("place"))
        fresh = links.join(reached.select("post_id", "url"), ["post_id", "url"], "left_anti")
        level = cut(fresh.join(landed, ["post_id", "url"]).select("post_id", "url", "place", "html"))
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
    order = Window.partitionBy("post_id").orderBy(F.size(F.split("place", "/")), "place")
    numbered = reached.drop("html").withColumn("page_no", (F.row_number().over(order) - 1).cast("int"))
    if max_continue:
        numbered = numbered.filter(F.col("page_no") <= max_continue)
    return numbered.join(reached.select("post_id", "url", "html"), ["post_id", "url"]).select("post_id", "page_no", "html")


def thread_run(posts: DataFrame, pages: DataFrame, fetched_at: str, options: Options) -> DataFrame:
    """Enriched comments of posts from landed thread pages (post_id, page_no, html); the last page of a comment counts, at the place of its first.

    A cap ends the walk at the comment that reaches it, so later pages do not count.
    """
    rows = html.thread_rows(pages.join(posts.select("post_id").distinct(), "post_id", "left_semi"), ["post_id", "page_no"], include_deleted=options.include_deleted)
    rows = rows.withColumn("order", F.struct("page_no", "seq"))
    if options.max_comments:
        firsts = rows.groupBy("post_id", "comment_id").agg(F.min("order").alias("order"))
        ends = firsts.withColumn("n", F.row_number().over(Window.partitionBy("post_id").orderBy("order"))).filter(F.col("n") == options.max_comments).select("post_id", F.col("order").alias("end"))
        rows = rows.join(ends, "post_id", "left").filter(F.col("end").isNull() | (F.col("order") <= F.col("end"))).drop("end")
    last = rows.groupBy("post_id", "comment_id").agg(F.max_by(F.struct("parent_id", "author", "body", "score", "depth", "created_utc", "permalink"), "order").alias("r")).select("post_id", "comment_id", "r.*")
    told = tree.enrich_context(cut(last.withColumn("thread_id", F.col("post_id"))), options.ancestor_limit)
    about = posts.select("post_id", F.col("title").alias("thread_title"), F.col("body").alias("thread_body"), "subreddit", "intake_mode", "matched_keyword", F.col("permalink").alias("thread_permalink"))
    return told.join(about, "post_id").withColumns({"created_iso": to_iso("created_utc"), "fetched_at": F.lit(fetched_at)})


def fetched_counts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """posts with fetched_comment_count."""
    counts = comments.groupBy("post_id").agg(F.count("*").cast("int").alias("fetched_comment_count"))
    return posts.join(counts, "post_id", "left").fillna(0, ["fetched_comment_count"])


def classification_run(comments: DataFrame, model: Callable, most: int = 40, limit: int = 400, seq: str = "seq") -> dict[str, DataFrame]:
    """requests, results and classified comments of one model function."""
    requests = classify.render_requests(classify.chunk_by_thread(comments, most, seq=seq), limit)
    results = cut(classify.classify(requests, model))
    answers = results.select("custom_id", F.explode("classifications").alias("a")).select("custom_id", "a.*")
    return {"requests": requests, "results": results, "classified": classify.attach(comments, answers, seq="custom_id"), "usage": classify.usage(results)}


def comparison_run(a: DataFrame, b: DataFrame, names: tuple[str, str]) -> dict[str, DataFrame]:
    """agreement and disagreements of two classified tables."""
    columns = ["icp_likelihood", "relevance_tag"]
    pairs = compare.pair_up(compare.with_missing(a), compare.with_missing(b), "comment_id", columns, names)
    return {"agreement": compare.agreement(pairs, columns, names), "disagreements": compare.disagreements(pairs, columns, names)}


def record_run(spark: SparkSession, events: DataFrame, run_id: str, seq: int, status: str, posts: int, comments: int) -> DataFrame:
    """events with one more run event."""
    row = spark.createDataFrame([(run_id, seq, status, posts, comments)], "run_id string, seq long, status string, post_count int, new_comment_count int")
    return events.unionByName(row)
