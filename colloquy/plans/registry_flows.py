"""More queries of the reference operators: landed pages, discovery, repair, exports, fetching, classification results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..operators import classify, discover, exports, fetch, repair, state
from ..schemas import POST, names
from ..session import shared_folder, table
from ..sources import files, html
from . import pipelines
from .registry import _LEVELS, _escaped, comments, query

OLD = 900.0  # documents stand for posts, their size for the time of the post


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def _joined(group, *parts, order: str = "doc_id", sep: str = "\n") -> Column:
    """The parts of a group's rows, in order, as one text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.concat(*parts).alias("x")))), lambda x: x["x"]), sep)


def _text(*parts) -> list[Column]:
    return [p if isinstance(p, Column) else F.lit(p) for p in parts]


# ---------------------------------------------------------------- landed pages

_STAMP = "'2024-01-01T' || lpad((doc_id % 24)::VARCHAR, 2, '0') || ':00:00Z'"
_SEEN = "epoch(TIMESTAMP '2024-01-01' + to_hours((doc_id % 24)::INT))"


def _stamp() -> Column:
    return F.concat(F.lit("2024-01-01T"), F.lpad((F.col("doc_id") % 24).cast("string"), 2, "0"), F.lit(":00:00Z"))


def _candidates(out):
    return out.select("source", "post_id", "title", "subreddit", "author", F.col("score").cast("bigint").alias("score"), F.col("num_comments").cast("bigint").alias("num_comments"), "created_utc", "permalink", "is_stickied")


@query(f"""
    SELECT source, 'D' || doc_id AS post_id, 'Post & ' || doc_id AS title, source AS subreddit, 'u' || doc_id % 9 AS author, doc_id % 50 AS score, n_chars AS num_comments, {_SEEN} AS created_utc,
           'https://old.reddit.com/r/' || source || '/comments/D' || doc_id || '/x/' AS permalink, doc_id % 5 = 0 AS is_stickied
    FROM documents WHERE doc_id % 7 <> 0""")
def listing_old_parse(spark, sf_dir):
    """Listing pages of the old layout, one a source; every seventh post is promoted."""
    kind = F.concat(F.lit("thing link"), F.when(F.col("doc_id") % 7 == 0, " promotedlink").otherwise(""), F.when(F.col("doc_id") % 5 == 0, " stickied").otherwise(""))
    one = _text(
        '<div class="', kind, '" data-fullname="t3_D', F.col("doc_id"), '" data-author="u', F.col("doc_id") % 9, '" data-score="', F.col("doc_id") % 50, '" data-comments-count="', F.col("n_chars"),
        '" data-permalink="/r/', F.col("source"), "/comments/D", F.col("doc_id"), '/x/"><a class="title">Post &amp;  ', F.col("doc_id"), '</a><time datetime="', _stamp(), '"></time></div>',
    )
    pages = _docs(spark, sf_dir).groupBy("source").agg(_joined("source", *one).alias("html"))
    return _candidates(html.listing_rows(pages, ["source"], community_column="source"))


@query(f"""
    SELECT source, 'D' || doc_id AS post_id, 'Post ' || doc_id AS title, upper(source) AS subreddit, 'u' || doc_id % 9 AS author, doc_id % 50 AS score, n_chars AS num_comments, {_SEEN} AS created_utc,
           'https://www.reddit.com/r/' || source || '/comments/D' || doc_id || '/x/' AS permalink, doc_id % 5 = 0 AS is_stickied
    FROM documents WHERE doc_id % 7 <> 0""")
def listing_modern_parse(spark, sf_dir):
    """Listing pages of the modern layout; titles of even posts are in a heading, every seventh post is promoted, every third comes twice."""
    head = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("><h2>Post "), "doc_id", F.lit("</h2>"))).otherwise(F.concat(F.lit(' post-title="Post '), "doc_id", F.lit('">')))
    one = _text(
        '<shreddit-post id="t3_D', F.col("doc_id"), '" author="u', F.col("doc_id") % 9, '" score="', F.col("doc_id") % 50, '" comment-count="', F.format_number("n_chars", 0), '" permalink="/r/', F.col("source"),
        "/comments/D", F.col("doc_id"), '/x/" subreddit-prefixed-name="r/', F.upper("source"), '" created-timestamp="', _stamp(), '"', F.when(F.col("doc_id") % 7 == 0, ' promoted="true"').otherwise(""),
        F.when(F.col("doc_id") % 5 == 0, " is-stickied").otherwise(' is-stickied="false"'), head, "</shreddit-post>",
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('<shreddit-post id="t3_D'), "doc_id", F.lit('"></shreddit-post>'))).otherwise(""),
    )
    pages = _docs(spark, sf_dir).groupBy("source").agg(_joined("source", *one).alias("html"))
    return _candidates(html.listing_rows(pages, ["source"], community_column="source"))


@query("""
    SELECT source, 'd' || doc_id AS post_id, 'A longer title ' || doc_id AS title, upper(source) AS subreddit, 'https://www.reddit.com/r/' || upper(source) || '/comments/d' || doc_id || '/x/' AS permalink FROM documents""")
def listing_links_merge(spark, sf_dir):
    """Pages of bare links: counters, controls, a short and a long title of each post, and links of other communities."""
    href = F.concat(F.lit('<a href="/r/'), F.upper("source"), F.lit("/comments/d"), "doc_id", F.lit('/x/">'))
    one = _text(href, "12 replies</a>", href, "Open post</a>", href, "Title ", F.col("doc_id"), "</a>", href, "A longer title ", F.col("doc_id"), "</a>", href, F.col("n_chars"), ' comments</a><a href="/r/elsewhere/comments/zz/">Not ours</a>')
    pages = _docs(spark, sf_dir).groupBy("source").agg(_joined("source", *one).alias("html"))
    return html.listing_rows(pages, ["source"], community_column="source").select("source", "post_id", "title", "subreddit", "permalink")


_LIVE = """
    SELECT source, 'd' || doc_id % 40 AS post_id, CASE WHEN doc_id % 4 = 0 THEN n_chars || ' comments' ELSE 'Title ' || n_chars END AS text, CASE WHEN doc_id % 3 = 0 THEN 'u/a' || doc_id ELSE '' END AS author,
           CASE WHEN doc_id % 5 = 0 THEN doc_id::DOUBLE END AS created, n_chars AS n, doc_id % 11 = 0 AS pin, doc_id AS seq FROM documents"""


@query(f"""
    WITH l AS (SELECT *, CASE WHEN text LIKE '%comments' THEN '' ELSE text END AS title FROM ({_LIVE}))
    SELECT source, post_id, first(title ORDER BY length(title) DESC, seq) AS title, coalesce(first(substr(author, 3) ORDER BY seq) FILTER (WHERE author <> ''), '') AS author,
           first(created ORDER BY seq) FILTER (WHERE created <> 0) AS created_utc, max(n) AS num_comments, bool_or(pin) AS is_stickied, min(seq) AS seq FROM l GROUP BY source, post_id""")
def live_links(spark, sf_dir):
    """Links of a live listing, several to a post, merged to the richest candidate."""
    post = F.concat(F.lit("d"), F.col("doc_id") % 40)
    rows = _docs(spark, sf_dir).select(
        "source", F.concat(F.lit("/r/"), "source", F.lit("/comments/"), post).alias("href"), F.lit("").alias("post_id"), F.lit("").alias("card_title"), F.lit(None).cast("string").alias("aria_label"), F.lit("").alias("title_attr"),
        F.when(F.col("doc_id") % 4 == 0, F.concat("n_chars", F.lit(" comments"))).otherwise(F.concat(F.lit("Title "), "n_chars")).alias("text"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("u/a"), "doc_id")).otherwise("").alias("author"),
        F.when(F.col("doc_id") % 5 == 0, F.col("doc_id").cast("string")).alias("created"), F.col("n_chars").cast("string").alias("comment_count"), F.lit("false").alias("stickied"),
        F.when(F.col("doc_id") % 11 == 0, "Pinned by  moderators").otherwise("").alias("card_text"), F.col("source").alias("community"), F.col("doc_id").alias("seq"),
    )
    return discover.link_candidates(rows, ["source"]).select("source", "post_id", "title", "author", "created_utc", "num_comments", "is_stickied", "seq")


@query("""
    WITH p AS (SELECT doc_id, 'T' || doc_id AS title, CASE WHEN doc_id % 2 = 0 THEN 'ann' ELSE '' END AS author, n_chars AS n FROM documents WHERE doc_id % 3 <> 0),
    l AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'Longer ' || doc_id ELSE 'x' END AS title, 'bob' AS author, 1000::BIGINT AS n FROM documents WHERE doc_id % 4 <> 0)
    SELECT coalesce(p.doc_id, l.doc_id) AS post_id, CASE WHEN p.doc_id IS NULL OR length(l.title) > length(p.title) THEN l.title ELSE p.title END AS title,
           CASE WHEN p.author <> '' THEN p.author ELSE coalesce(l.author, p.author) END AS author, NULL::DOUBLE AS created_utc, greatest(coalesce(p.n, 0), coalesce(l.n, 0)) AS num_comments
    FROM p FULL JOIN l ON p.doc_id = l.doc_id""")
def live_merge(spark, sf_dir):
    d = _docs(spark, sf_dir)
    none = F.lit(None).cast("double").alias("created_utc")
    parsed = d.filter("doc_id % 3 <> 0").select(F.col("doc_id").alias("post_id"), F.concat(F.lit("T"), "doc_id").alias("title"), F.when(F.col("doc_id") % 2 == 0, "ann").otherwise("").alias("author"), none, F.col("n_chars").alias("num_comments"))
    live = d.filter("doc_id % 4 <> 0").select(F.col("doc_id").alias("post_id"), F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("Longer "), "doc_id")).otherwise("x").alias("title"), F.lit("bob").alias("author"), none, F.lit(1000).cast("bigint").alias("num_comments"))
    return discover.merge_live(parsed, live)


@query("""
    SELECT doc_id AS post_id, CASE WHEN doc_id % 2 = 0 THEN 'Page ' || doc_id ELSE 'Listed ' || doc_id END AS title, CASE WHEN doc_id % 2 = 0 THEN 'Said ' || lang ELSE '' END AS body, source AS author,
           CASE WHEN doc_id % 2 = 0 THEN 5 ELSE 1 END::BIGINT AS score, CASE WHEN doc_id % 4 = 0 THEN n_chars ELSE 7 END::BIGINT AS num_comments FROM documents""")
def post_page_parse(spark, sf_dir):
    """Posts of thread pages over their candidates: what a page does not say stays as it was listed."""
    d = _docs(spark, sf_dir)
    one = F.concat(F.lit('<shreddit-post id="t3_'), "doc_id", F.lit('" post-title="Page '), "doc_id", F.lit('" score="5"'), F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit(' comment-count="'), "n_chars", F.lit('"'))).otherwise(""), F.lit('><div slot="text-body"><p>Said  '), "lang", F.lit("</p></div></shreddit-post>"))
    pages = d.select(F.col("doc_id").cast("string").alias("post_id"), F.when(F.col("doc_id") % 2 == 0, one).otherwise("<p>nothing</p>").alias("html"))
    listed = d.select(F.col("doc_id").cast("string").alias("post_id"), F.concat(F.lit("Listed "), "doc_id").alias("title"), F.lit("").alias("body"), F.col("source").alias("author"), F.lit(1).cast("bigint").alias("score"), F.lit(7).cast("bigint").alias("num_comments"))
    return discover.page_over_candidate(listed, html.post_rows(pages, ["post_id"])).withColumn("post_id", F.col("post_id").cast("bigint"))


@query(f"""
    WITH c AS ({_LEVELS}),
    last AS (SELECT a.conv_id, a.turn, a.d, max(b.turn) AS j FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id AND b.turn < a.turn AND b.d < a.d GROUP BY ALL)
    SELECT 'p' || last.conv_id AS post_id, 'c' || last.conv_id || '_' || last.turn AS comment_id, last.d AS depth, CASE WHEN last.turn % 2 = 0 THEN 'p' || last.conv_id
           WHEN last.d = 0 THEN 'p' || last.conv_id WHEN c.d = last.d - 1 THEN 'c' || c.conv_id || '_' || c.turn ELSE '' END AS parent_id, last.turn AS score,
           'https://old.reddit.com/r/x/c' || last.conv_id || '_' || last.turn || '/' AS permalink
    FROM last LEFT JOIN c ON c.conv_id = last.conv_id AND c.turn = last.j""")
def thread_old_parse(spark, sf_dir):
    """Thread pages of the old layout, flat; even turns name their parent, the others are placed by depth and order."""
    c = comments(spark, sf_dir).withColumn("turn", F.col("seq") % 100000)
    one = _text(
        '<div class="thing comment" data-fullname="t1_', F.col("comment_id"), '" data-depth="', F.col("level"), '"', F.when(F.col("turn") % 2 == 0, F.concat(F.lit(' data-parent-fullname="t3_'), "post_id", F.lit('"'))).otherwise(""),
        '><div class="entry"><a class="author">', F.col("author"), '</a><span class="score" title="', F.col("turn"), ' points"></span><div class="usertext-body"><div class="md"><p>', _escaped("body"),
        ' x</p></div></div><a class="bylink" href="/r/x/', F.col("comment_id"), '/">link</a></div></div>',
    )
    pages = c.groupBy("post_id").agg(_joined("post_id", *one, order="seq").alias("html"))
    out = html.thread_rows(pages, ["post_id"])
    return out.select("post_id", "comment_id", F.col("depth").cast("bigint").alias("depth"), "parent_id", "score", "permalink")


@query("""
    SELECT 'p' || conv_id AS post_id, 'c' || conv_id || '_' || turn AS comment_id, turn AS depth, CASE WHEN turn = 3 THEN 'again' WHEN turn < 3 THEN 'first' ELSE 'more' END AS body, least(count(*) OVER (PARTITION BY conv_id), 8) AS fetched_comment_count
    FROM conversations WHERE turn < 8""")
def thread_assembly(spark, sf_dir):
    """Threads over a first page, two that continue it and one beyond the cap; the last page of a comment counts."""
    c = comments(spark, sf_dir, "chain").withColumn("turn", F.col("seq") % 100000)
    one = lambda body: F.concat(F.lit('<shreddit-comment thingid="t1_'), "comment_id", F.lit('" parentid="'), F.when(F.col("turn") == 0, F.concat(F.lit("t3_"), "post_id")).otherwise(F.concat(F.lit("t1_"), "parent_id")), F.lit(f'"><div slot="comment">{body}</div></shreddit-comment>'))
    link = lambda k: F.when(F.max("turn") > 4 * k - 1 if k else F.lit(True), F.concat(F.lit('<a href="/t/'), F.first("post_id"), F.lit(f'/{k + 1}/">continue this thread</a>'))).otherwise("")
    pages = []
    for k, (low, high, body) in enumerate(((0, 4, "first"), (3, 6, "more"), (6, 8, "more"), (8, 99, "never"))):
        text = F.when(F.col("turn") == 3, one("again")).otherwise(one(body)) if k == 1 else one(body)
        part = c.filter((F.col("turn") >= low) & (F.col("turn") < high)).groupBy("post_id").agg(_joined("post_id", text, order="turn").alias("body"))
        url = F.concat(F.lit("https://www.reddit.com/t/"), "post_id", F.lit(f"/{k}/?limit=500&sort=confidence&show=all"))
        pages.append(part.select("post_id", (url if k else F.lit(None).cast("string")).alias("url"), F.concat("body", F.lit('<a href="/t/'), "post_id", F.lit(f'/{k + 1}/">Continue this  thread</a>')).alias("html")))
    landed = pages[0]
    for p in pages[1:]:
        landed = landed.unionByName(p)
    posts = c.select("post_id").distinct().select("post_id", *[F.lit("").alias(x) for x in ("title", "body", "subreddit", "intake_mode", "matched_keyword", "permalink")])
    walked = pipelines.thread_pages(posts, landed, max_continue=2)
    found = pipelines.thread_run(posts, walked, "", pipelines.Options())
    counts = pipelines.fetched_counts(posts, found).select("post_id", F.col("fetched_comment_count").cast("bigint").alias("fetched_comment_count"))
    return found.join(counts, "post_id").select("post_id", "comment_id", F.col("depth").cast("bigint").alias("depth"), "body", "fetched_comment_count")


# ---------------------------------------------------------------- discovery

_PAGES = "SELECT source, doc_id, n // 5 + 1 AS page_no, n % 5 AS seq, CASE WHEN doc_id % 13 = 0 THEN NULL ELSE n_chars::DOUBLE END AS created, doc_id % 11 = 0 AS pin FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS n FROM documents)"


def _landed(spark, sf_dir):
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    rows = _docs(spark, sf_dir).withColumn("n", n)
    return rows.select(
        "source", F.regexp_extract("source", "([0-9]+)$", 1).cast("int").alias("source_no"), (F.floor(F.col("n") / 5) + 1).cast("int").alias("page_no"), (F.col("n") % 5).cast("bigint").alias("seq"),
        F.col("doc_id").cast("string").alias("post_id"), F.when(F.col("doc_id") % 13 != 0, F.col("n_chars").cast("double")).alias("created_utc"), (F.col("doc_id") % 11 == 0).alias("is_stickied"), F.lit(9).alias("num_comments"),
    )


@query(f"""
    WITH p AS ({_PAGES}), g AS (SELECT source, page_no, bool_or(created IS NULL OR created >= {OLD}) AS fresh FROM p GROUP BY ALL), e AS (SELECT source, min(page_no) FILTER (WHERE NOT fresh) AS stop FROM g GROUP BY 1)
    SELECT source, doc_id::VARCHAR AS post_id, page_no FROM p JOIN e USING (source) WHERE page_no <= 6 AND (stop IS NULL OR page_no <= stop) AND (created IS NULL OR created >= {OLD}) AND NOT pin
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY page_no, seq) <= 9""")
def listing_walk(spark, sf_dir):
    out = discover.walk_listing(_landed(spark, sf_dir), OLD, max_pages=6, max_posts=9)
    return out.select("source", "post_id", F.col("page_no").cast("bigint").alias("page_no"))


@query(f"""
    WITH p AS ({_PAGES}), g AS (SELECT source, page_no, bool_or(created < {OLD}) AS old FROM p GROUP BY ALL), e AS (SELECT source, min(page_no) FILTER (WHERE old) AS stop FROM g GROUP BY 1)
    SELECT source, doc_id::VARCHAR AS post_id, page_no FROM p JOIN e USING (source) WHERE page_no <= 4 AND (stop IS NULL OR page_no <= stop) AND (created IS NULL OR created >= {OLD})""")
def feed_walk(spark, sf_dir):
    return discover.walk_feed(_landed(spark, sf_dir), OLD, max_pages=4).select("source", "post_id", F.col("page_no").cast("bigint").alias("page_no"))


_TERMS = "(VALUES (0, 'zeta'), (1, 'alpha'), (2, 'zeta')) k(kw_seq, keyword)"


def _searched(spark, sf_dir):
    terms = spark.createDataFrame([(0, "zeta"), (1, "alpha"), (2, "zeta")], "kw_seq int, keyword string")
    return _landed(spark, sf_dir).withColumn("doc", F.col("post_id").cast("bigint")).join(F.broadcast(terms), F.col("doc") % 3 <= F.col("kw_seq")).drop("doc")


@query(f"""
    WITH p AS ({_PAGES}), s AS (SELECT * FROM p, {_TERMS} WHERE doc_id % 3 <= kw_seq AND page_no <= 3 AND NOT pin)
    SELECT source, doc_id::VARCHAR AS post_id, CASE doc_id % 3 WHEN 0 THEN 'zeta; alpha' WHEN 1 THEN 'alpha; zeta' ELSE 'zeta' END AS matched_keyword FROM s GROUP BY ALL""")
def search_walk(spark, sf_dir):
    out = discover.walk_searches(_searched(spark, sf_dir), None, max_pages=3, stop_when_old=False)
    return out.select("source", "post_id", "matched_keyword")


@query("""
    WITH s AS (SELECT doc_id % 50 AS id, doc_id AS n, CASE WHEN doc_id % 2 = 0 THEN lang || '; zz' ELSE '' END AS k FROM documents WHERE doc_id < 120),
    t AS (SELECT id, trim(unnest(string_split(k, ';'))) AS term FROM s),
    u AS (SELECT id, string_agg(DISTINCT term, '; ' ORDER BY term) FILTER (WHERE term <> '') AS terms FROM t GROUP BY 1)
    SELECT id::VARCHAR AS post_id, min(n) AS source_no, CASE WHEN count(*) > 1 THEN coalesce(any_value(terms), '') ELSE any_value(k) END AS matched_keyword FROM s JOIN u USING (id) GROUP BY id""")
def source_merge(spark, sf_dir):
    rows = _docs(spark, sf_dir).filter("doc_id < 120").select((F.col("doc_id") % 50).cast("string").alias("post_id"), F.col("doc_id").alias("source_no"), F.when(F.col("doc_id") % 2 == 0, F.concat("lang", F.lit("; zz"))).otherwise("").alias("matched_keyword"))
    return discover.merge_sources(rows)


@query(f"""
    WITH p AS ({_PAGES}), g AS (SELECT source, page_no, bool_or(created IS NULL OR created >= {OLD}) AS fresh FROM p GROUP BY ALL), e AS (SELECT source, min(page_no) FILTER (WHERE NOT fresh) AS stop FROM g GROUP BY 1),
    w AS (SELECT source, doc_id, page_no, seq FROM p JOIN e USING (source) WHERE page_no <= 4 AND (stop IS NULL OR page_no <= stop) AND (created IS NULL OR created >= {OLD}) AND NOT pin),
    n AS (SELECT * FROM w WHERE doc_id NOT IN (SELECT doc_id FROM labels) QUALIFY row_number() OVER (PARTITION BY source ORDER BY page_no, seq) <= 3)
    SELECT source, doc_id::VARCHAR AS post_id FROM n""")
def discovery_run(spark, sf_dir):
    """Pages walked, known posts left out, then the cap, then posts of several sources merged."""
    known = table(spark, sf_dir, "labels").select(F.concat(F.lit("t3_"), "doc_id").alias("post_id"))
    options = pipelines.Options(days=1, max_pages=4, max_posts=3, min_comments=9)
    rows = _landed(spark, sf_dir)
    none = rows.limit(0).select("*", F.lit(0).alias("kw_seq"), F.lit("").alias("keyword"))
    return pipelines.discovery_run(rows, none, known, OLD + 86400, options).select("source", "post_id")


@query("SELECT event_id FROM events WHERE event_type IN ('error', 'signup') OR epoch(ts) >= 1705276800")
def recency_zero_days(spark, sf_dir):
    """Zero days are a cutoff at now in one export."""
    created = F.when(F.col("event_type") == "signup", F.lit(0.0)).when(F.col("event_type") != "error", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    return table(spark, sf_dir, "events").filter(discover.recent(created, discover.cutoff(1705276800.0, 0, False))).select("event_id")


@query("SELECT doc_id, title FROM (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '12 comments' WHEN 1 THEN 'Open post' WHEN 2 THEN '' WHEN 3 THEN '3.5 votes' WHEN 4 THEN 'Replies' ELSE 'Real ' || doc_id END AS a FROM documents), LATERAL (SELECT CASE WHEN a LIKE 'Real%' THEN a ELSE 'lang ' || doc_id END AS title)")
def title_choice(spark, sf_dir):
    a = F.element_at(F.array(F.lit("12 comments"), F.lit("Open post"), F.lit(""), F.lit("3.5 votes"), F.lit("Replies"), F.concat(F.lit("Real "), "doc_id")), (F.col("doc_id") % 6 + 1).cast("int"))
    rows = _docs(spark, sf_dir).withColumns({"a": a, "b": F.concat(F.lit("  lang\n"), "doc_id")})
    return rows.select("doc_id", discover.title_of("a", "b").alias("title"))


@query("SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 5 NOT IN (0, 1) AND lang = 'de'")
def candidate_filters(spark, sf_dir):
    """Neither stickied nor gone, and of the community, case aside."""
    rows = _docs(spark, sf_dir).withColumns({"is_stickied": F.when(F.col("doc_id") % 4 != 1, F.col("doc_id") % 4 == 0), "body": F.when(F.col("doc_id") % 5 == 0, " [Removed] ").when(F.col("doc_id") % 5 == 1, "").otherwise("text")})
    return discover.without_gone(rows.filter(discover.not_stickied()).filter(discover.same_community("lang", "DE"))).select("doc_id")


@query("""
    SELECT page_id, regexp_matches(u, '(?i)/r/([^/]+)/comments/([a-z0-9]+)') AS is_post, regexp_extract(u, '(?i)/r/([^/?#]+)', 1) AS community,
           CASE WHEN u LIKE 'http%' THEN u || ' ' || replace(u, 'old.', 'www.') ELSE 'https://www.reddit.com' || u || ' https://old.reddit.com' || u END AS forms
    FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/r/c' || page_id || '/comments/a' || page_id || '/x/' WHEN 1 THEN 'https://old.reddit.com/r/c/comments/-' || page_id ELSE '/r/c' || page_id || '/' END AS u FROM pages)""")
def url_forms(spark, sf_dir):
    p = F.col("page_id")
    u = F.when(p % 3 == 0, F.concat(F.lit("/r/c"), p, F.lit("/comments/a"), p, F.lit("/x/"))).when(p % 3 == 1, F.concat(F.lit("https://old.reddit.com/r/c/comments/-"), p)).otherwise(F.concat(F.lit("/r/c"), p, F.lit("/")))
    return table(spark, sf_dir, "pages").select("page_id", U.is_post_path(u).alias("is_post"), U.community(u).alias("community"), F.array_join(U.variants(u), " ").alias("forms"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) / 1e6 WHEN 1 THEN epoch(date_trunc('second', ts)) WHEN 2 THEN 1.5 END AS created FROM events")
def created_forms(spark, sf_dir):
    """Dates as ISO text with and without fractions, as numbers, and as neither."""
    at = F.col("event_id") % 4
    text = F.when(at == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")).when(at == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).when(at == 2, "1.5").otherwise("soon")
    return table(spark, sf_dir, "events").select("event_id", X.parse_created(text).alias("created"))


@query("SELECT doc_id, row_number() OVER (ORDER BY CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars END DESC, doc_id)::BIGINT AS ordinal FROM documents")
def newest_first(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("n_chars").cast("double")).alias("created_utc"))
    return discover.newest_first(rows, seq="doc_id").select("doc_id", F.col("ordinal").cast("bigint").alias("ordinal"))


@query("SELECT doc_id, CASE lang WHEN 'en' THEN 'full_scrape' WHEN 'de' THEN 'keyword_search' END AS paid, CASE lang WHEN 'de' THEN 'keyword_search' ELSE 'full_scrape' END AS keyless FROM documents")
def source_types(spark, sf_dir):
    kind = F.when(F.col("lang") == "en", "full_scrape").when(F.col("lang") == "de", "keyword_search").otherwise("odd")
    return _docs(spark, sf_dir).select("doc_id", discover.by_type(kind, True).alias("paid"), discover.by_type(kind, False).alias("keyless"))


@query("SELECT doc_id, lang AS term FROM documents WHERE contains(lower(strip_accents(split_part(coalesce(text, ''), chr(10), 1))), lang)")
def search_hits(spark, sf_dir):
    """Search results whose title holds the term that found them."""
    rows = _docs(spark, sf_dir).select("doc_id", F.substring_index(F.coalesce("text", F.lit("")), "\n", 1).alias("title"), F.upper("lang").alias("term"))
    return discover.literal_hits(rows).select("doc_id", F.lower("term").alias("term"))


# ---------------------------------------------------------------- repair

_LINE = """CASE doc_id % 7 WHEN 0 THEN '# note' WHEN 1 THEN '  ' WHEN 2 THEN ' t3_Ab' || doc_id || ' ' WHEN 3 THEN 'Ab' || doc_id - 1 WHEN 4 THEN 'https://x.example/r/Cee/Comments/Ab' || doc_id || '/s?x=1' WHEN 5 THEN 'no id ' || doc_id ELSE '/r/x/comments/ab' || doc_id END"""


def _lines(spark, sf_dir):
    d = F.col("doc_id")
    line = F.element_at(F.array(
        F.lit("# note"), F.lit("  "), F.concat(F.lit(" t3_Ab"), d, F.lit(" ")), F.concat(F.lit("Ab"), d - 1), F.concat(F.lit("https://x.example/r/Cee/Comments/Ab"), d, F.lit("/s?x=1")), F.concat(F.lit("no id "), d), F.concat(F.lit("/r/x/comments/ab"), d),
    ), (d % 7 + 1).cast("int"))
    return _docs(spark, sf_dir).select(d.alias("seq"), line.alias("line"))


@query(f"""
    WITH l AS (SELECT doc_id AS seq, trim({_LINE}) AS line FROM documents)
    SELECT seq, CASE seq % 7 WHEN 2 THEN 'ab' || seq WHEN 3 THEN 'ab' || seq - 1 WHEN 4 THEN 'ab' || seq END AS post_id, CASE WHEN seq % 7 = 4 THEN line END AS given,
           CASE WHEN seq % 7 IN (5, 6) THEN 'line ' || seq || ': no post id in ' || line END AS error
    FROM l WHERE seq % 7 > 1""")
def repair_lines(spark, sf_dir):
    return repair.targets(_lines(spark, sf_dir))


@query("""
    WITH t AS (SELECT min(doc_id) AS seq, CASE WHEN doc_id % 7 = 3 THEN doc_id - 1 ELSE doc_id END AS n, any_value(CASE WHEN doc_id % 7 = 4 THEN 'https://x.example/r/Cee/Comments/Ab' || doc_id || '/s?x=1' END) AS given
               FROM documents WHERE doc_id % 7 IN (2, 3, 4) GROUP BY 2),
    s AS (SELECT doc_id, source, lang, n_chars FROM documents WHERE doc_id % 2 = 0)
    SELECT seq, CASE WHEN s.doc_id IS NULL THEN 'ab' || n ELSE 't3_ab' || n END AS post_id, coalesce(given, CASE WHEN s.doc_id IS NOT NULL THEN '/kept/' || n END, 'https://www.reddit.com/comments/ab' || n || '/') AS permalink,
           coalesce(source, CASE WHEN given IS NULL THEN '' ELSE 'Cee' END) AS subreddit, coalesce('newer ' || lang, '') AS title, coalesce(source, 'repair') AS source_type, n_chars::INT AS num_comments, 'repair' AS intake_mode
    FROM t LEFT JOIN s ON s.doc_id = t.n""")
def repair_resolve(spark, sf_dir):
    """Targets of a list with what the latest state row of each knows."""
    d = _docs(spark, sf_dir).filter("doc_id % 2 = 0")
    row = lambda stamp, title: d.select(F.concat(F.lit("t3_ab"), "doc_id").alias("post_id"), F.concat(F.lit("/kept/"), "doc_id").alias("permalink"), F.col("source").alias("subreddit"), F.concat(F.lit(title), "lang").alias("title"), F.col("source").alias("source_type"), F.lit("").alias("matched_keyword"), F.col("n_chars").alias("reported_comment_count"), F.lit(stamp).alias("last_scraped_at"))
    known = row("2024-01-01", "older ").unionByName(row("2024-02-01", "newer "))
    return repair.resolve(repair.once(repair.targets(_lines(spark, sf_dir))), known).drop("matched_keyword")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'A' || doc_id END AS post_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE 'ex' END AS subreddit, 'https://old.reddit.com/r/' || CASE WHEN doc_id % 3 = 0 THEN source || '/' ELSE 'ex/comments/A' || doc_id || '/slug/' END AS permalink,
           CASE WHEN doc_id % 3 = 0 THEN 'no post id in https://www.reddit.com/r/' || source || '/' END AS error FROM documents""")
def manual_posts(spark, sf_dir):
    url = F.concat(F.lit("https://www.reddit.com/r/"), F.when(F.col("doc_id") % 3 == 0, F.concat("source", F.lit("/"))).otherwise(F.concat(F.lit("ex/comments/A"), "doc_id", F.lit("/slug/"))))
    return discover.manual_candidates(_docs(spark, sf_dir).select("doc_id", url.alias("url"))).select("doc_id", "post_id", "subreddit", "permalink", "error")


@query("""
    WITH c AS (SELECT conv_id, turn, 'c' || conv_id || '_' || turn AS id FROM conversations WHERE conv_id % 2 = 0)
    SELECT 't' || conv_id AS thread_id, id AS comment_id, turn % 2 = 1 AS is_new FROM c""")
def repair_run(spark, sf_dir):
    """A repair opens its targets' trees only, and exports new and known comments alike."""
    from .registry import _json_pages

    c = comments(spark, sf_dir)
    lines = c.select("thread_id").distinct().withColumn("n", F.substring("thread_id", 2, 20).cast("bigint")).filter("n % 2 = 0").select(F.col("n").alias("seq"), F.concat(F.lit("t3_"), "thread_id").alias("line"))
    known_posts = spark.createDataFrame([], "post_id string, permalink string, subreddit string, title string, source_type string, matched_keyword string")
    known = c.filter("seq % 2 = 0").select("comment_id")
    out = pipelines.repair_run(lines, known_posts, _json_pages(spark, sf_dir, 4), known, pipelines.Options(max_pages=0))
    return out["comments"].select("thread_id", "comment_id", "is_new")


@query("""
    SELECT comment_id, min(s) AS first_seen_at FROM (SELECT 'k' || user_id AS comment_id, strftime(min(ts), '%Y-%m-%d') AS s FROM events WHERE user_id % 2 = 0 GROUP BY 1
      UNION ALL SELECT 'k' || user_id, '2030-01-01' FROM events) GROUP BY 1""")
def legacy_import(spark, sf_dir):
    """Ids of an older ledger come in once, behind those that the state has."""
    e = table(spark, sf_dir, "events")
    have = e.filter("user_id % 2 = 0").groupBy(F.concat(F.lit("k"), "user_id").alias("comment_id")).agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("first_seen_at"))
    return state.import_ids(have, e.select(F.concat(F.lit(" k"), "user_id", F.lit(" ")).alias("comment_id")), "2030-01-01")


# ---------------------------------------------------------------- exports


@query("""SELECT doc_id::VARCHAR AS doc_id, source || '", "' || lang || chr(10) || 'naïve “x”' AS body, coalesce(source, '') AS source, '' AS extra FROM documents""")
def csv_roundtrip(spark, sf_dir):
    """An export appended in two runs and read back: quotes, line ends, blank columns."""
    path = f"{shared_folder(spark, 'export')}/rows"
    rows = _docs(spark, sf_dir).select("doc_id", F.concat("source", F.lit('", "'), "lang", F.lit("\nnaïve “x”")).alias("body"), "source", "n_chars")
    for part in ("doc_id % 2 = 0", "doc_id % 2 = 1", "false"):
        exports.append_csv(rows.filter(part), path, ["doc_id", "body", "source", "extra"])
    return files.read_csv(spark, path)


@query("SELECT DISTINCT 'k' || doc_id % 10 AS key FROM documents")
def key_set(spark, sf_dir):
    path = f"{shared_folder(spark, 'keys')}/rows"
    exports.append_csv(_docs(spark, sf_dir).select(F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.concat(F.lit(" k"), F.col("doc_id") % 10, F.lit(" "))).alias("key")), path, ["key"])
    return files.key_set(spark, path, "key")


@query("""
    SELECT 'p' || c_custkey AS post_id, CASE WHEN o IS NULL THEN c_mktsegment ELSE 'order ' || o END AS title, CASE WHEN o IS NULL THEN 'first' ELSE '' END AS author
    FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey""")
def master_upsert(spark, sf_dir):
    """A master export written, then upserted: whole rows are replaced, their places stay."""
    folder = shared_folder(spark, "master")
    first = table(spark, sf_dir, "customer").select(F.concat(F.lit("p"), "c_custkey").alias("post_id"), F.col("c_mktsegment").alias("title"), F.lit("first").alias("author"), F.col("c_custkey").alias("seq"))
    then = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.concat(F.lit("p"), "o_custkey").alias("post_id"), F.concat(F.lit("order "), "o_orderkey").alias("title"), F.col("o_orderkey").alias("seq"))
    exports.upsert_csv(first, folder, names(POST), "post_id", "1")
    exports.upsert_csv(then, folder, names(POST), "post_id", "2")
    return exports.read_export(spark, folder).select("post_id", "title", "author")


@query("""
    SELECT 'insert' AS mode, count(DISTINCT o_custkey)::BIGINT AS written FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL SELECT 'update', count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def master_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    parts = [exports.checkpoint(orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'"), "o_custkey", "o_orderkey", update)[1].select(F.lit(mode).alias("mode"), "written") for mode, update in (("insert", False), ("update", True))]
    return parts[0].unionByName(parts[1])


@query("SELECT 'r' || doc_id % 2 AS run_id, count(*)::BIGINT AS posts, sum(length(source))::BIGINT AS size FROM documents GROUP BY 1")
def run_snapshots(spark, sf_dir):
    folder = shared_folder(spark, "snapshots")
    d = _docs(spark, sf_dir)
    for k in range(2):
        exports.write_snapshot(folder, f"r{k}", d.limit(0), d.filter(F.col("doc_id") % 2 == k).select(F.col("doc_id").alias("post_id"), F.col("source").alias("title")))
    parts = [files.read_csv(spark, f"{folder}/run_id=r{k}/posts").agg(F.lit(f"r{k}").alias("run_id"), F.count("*").alias("posts"), F.sum(F.length("title")).alias("size")) for k in range(2)]
    return parts[0].unionByName(parts[1])


_FAILED = "SELECT 'd' || doc_id AS post_id, lang AS title, CASE WHEN doc_id % 3 = 0 THEN '' ELSE '/r/x/comments/d' || doc_id || '/' END AS permalink, (doc_id % 4)::INT AS attempt, 'timeout' AS error, '2024' AS failed_at FROM documents WHERE doc_id % 5 = 0"


def _failed(spark, sf_dir):
    link = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("/r/x/comments/d"), "doc_id", F.lit("/")))
    rows = _docs(spark, sf_dir).select(F.concat(F.lit("d"), "doc_id").alias("post_id"), F.col("lang").alias("title"), link.alias("permalink"), (F.col("doc_id") % 4).cast("int").alias("attempt"), F.when(F.col("doc_id") % 5 == 0, "timeout").alias("error"))
    return exports.failures(rows, "2024")


@query(_FAILED)
def failure_list(spark, sf_dir):
    return _failed(spark, sf_dir)


@query(f"SELECT CASE WHEN permalink = '' THEN post_id ELSE permalink END AS line FROM ({_FAILED})")
def failed_targets(spark, sf_dir):
    return exports.failed_targets(_failed(spark, sf_dir))


@query("""
    SELECT 'c' || doc_id AS comment_id, replace(source, '1', '') AS author, 'a b' AS body, CASE WHEN doc_id % 5 = 0 THEN '' ELSE (doc_id % 5)::VARCHAR END AS score, (doc_id % 3)::INT AS depth,
           CASE WHEN doc_id % 2 = 0 THEN '' ELSE '1970-01-01T00:00:01+00:00' END AS created_iso FROM documents""")
def short_comment_rows(spark, sf_dir):
    """The short export erases zeros."""
    rows = _docs(spark, sf_dir).select(
        F.concat(F.lit("c"), "doc_id").alias("comment_id"), F.replace("source", F.lit("1"), F.lit("")).alias("author"), F.lit(" a\nb ").alias("body"), (F.col("doc_id") % 5).alias("score"), (F.col("doc_id") % 3).cast("int").alias("depth"),
        (F.col("doc_id") % 2).cast("double").alias("created_utc"), *[F.lit(None).cast("string").alias(c) for c in ("thread_id", "thread_title", "subreddit", "intake_mode", "matched_keyword", "parent_id", "permalink", "thread_permalink")],
    )
    return exports.short_comments(rows, "2024").select("comment_id", "author", "body", "score", "depth", "created_iso")


@query("""
    SELECT 'd' || doc_id AS post_id, source AS subreddit, 'full_scrape' AS source_type, '' AS matched_keyword, 'T ' || doc_id AS title, CASE WHEN doc_id % 5 = 0 THEN '' ELSE (doc_id % 5)::VARCHAR END AS score, n_chars::VARCHAR AS num_comments,
           '' AS created_utc, '' AS created_iso, 'https://www.reddit.com/r/d' || doc_id AS permalink FROM documents""")
def discovery_export(spark, sf_dir):
    """The count comes as text, so that a zero stays; the score as a number, so that it goes."""
    rows = _docs(spark, sf_dir).select(F.concat(F.lit("d"), "doc_id").alias("post_id"), F.col("source").alias("subreddit"), F.lit("full_scrape").alias("source_type"), F.lit(None).cast("string").alias("matched_keyword"), F.concat(F.lit("T\n"), "doc_id").alias("title"), (F.col("doc_id") % 5).alias("score"), F.col("n_chars").cast("string").alias("num_comments"), F.lit(0.0).alias("created_utc"), F.concat(F.lit("/r/d"), "doc_id").alias("permalink"))
    return exports.discovered(rows)


# ---------------------------------------------------------------- fetching


@query("SELECT doc_id, CASE WHEN n_chars < 1000 AND n_chars > 0 AND doc_id % 3 = 0 THEN 'full' WHEN n_chars < 1000 THEN 'cheap' ELSE 'full' END AS route FROM documents")
def cheap_fallback(spark, sf_dir):
    """The cheap way that brought nothing for a post with comments gives way to the full one."""
    rows = _docs(spark, sf_dir).select("doc_id", F.lit("full_scrape").alias("intake_mode"), F.col("n_chars").alias("num_comments"), F.when(F.col("doc_id") % 3 == 0, 0).otherwise(5).alias("fetched"))
    return rows.select("doc_id", discover.reroute(discover.route(1000), "fetched", "num_comments").alias("route"))


@query("""
    WITH f AS (SELECT user_id, min(event_id) AS e FROM events WHERE event_type <> 'error' GROUP BY 1), k AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 20)
    SELECT f.user_id::VARCHAR AS comment_id, e AS seq, k.user_id IS NULL AS is_new FROM f LEFT JOIN k USING (user_id)""")
def repair_export(spark, sf_dir):
    """All fetched comments, each once, marked as new or known."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("comment_id"), F.col("event_id").alias("seq"), "event_type", "value")
    known = e.filter("event_type = 'purchase' AND value > 20").select("comment_id")
    return fetch.exported(e.filter("event_type <> 'error'").select("comment_id", "seq"), known, every=True).select("comment_id", "seq", "is_new")


_PASSES = """
    r AS (SELECT DISTINCT user_id AS post, 1 + event_id % 4 AS p, (event_id % 23)::VARCHAR AS c FROM events),
    a AS (SELECT post, c, min(p) AS p FROM r GROUP BY ALL), n AS (SELECT post, p, count(*) AS added FROM a GROUP BY ALL),
    w AS (SELECT u.post, k.p, coalesce(added, 0) AS added, sum(coalesce(added, 0)) OVER (PARTITION BY u.post ORDER BY k.p) AS upto, u.post % 5 = k.p AS done, u.post % 30 AS expected
          FROM (SELECT DISTINCT post FROM r) u, (VALUES (1), (2), (3), (4)) k(p) LEFT JOIN n ON n.post = u.post AND n.p = k.p),
    s AS (SELECT *, min(CASE WHEN done OR (expected > 0 AND upto >= expected) OR (added = 0 AND p > 1) THEN p END) OVER (PARTITION BY post) AS stop FROM w),
    v AS (SELECT * FROM s WHERE stop IS NULL OR p <= stop)"""


@query(f"""
    WITH {_PASSES}
    SELECT post::VARCHAR AS post_id, count(*)::BIGINT AS calls, max(upto)::BIGINT AS collected, CASE WHEN arg_max(done, p) THEN false ELSE any_value(expected) > 0 AND max(upto) < any_value(expected) END AS truncated FROM v GROUP BY post""")
def sort_passes(spark, sf_dir):
    """Union over sort passes, ended by what is expected, by a pass that adds nothing, or by one that says it is whole."""
    e = table(spark, sf_dir, "events")
    rows = e.select(F.col("user_id").cast("string").alias("post_id"), (F.col("event_id") % 4 + 1).cast("int").alias("pass_no"), F.col("event_id").alias("seq"), (F.col("event_id") % 23).cast("string").alias("comment_id"))
    p = e.select("user_id").distinct().withColumn("pass_no", F.explode(F.array(*map(F.lit, (1, 2, 3, 4)))))
    passes = p.select(F.col("user_id").cast("string").alias("post_id"), "pass_no", F.lit(True).alias("has_data"), F.when(F.col("user_id") % 5 == F.col("pass_no"), F.lit(False)).alias("meta_truncated"), (F.col("user_id") % 30).alias("expected"))
    return fetch.union_passes(passes, rows)[1]


@query("""
    SELECT count(*) FILTER (WHERE NOT k)::BIGINT AS posts, count(*) FILTER (WHERE NOT k AND c)::BIGINT AS posts_cheap, count(*) FILTER (WHERE NOT k AND NOT c)::BIGINT AS posts_full, count(*) FILTER (WHERE k)::BIGINT AS posts_skipped,
           sum(n) FILTER (WHERE NOT k AND c)::BIGINT AS calls_cheap, sum(n) FILTER (WHERE NOT k AND NOT c)::BIGINT AS calls_full, sum(n * 2) FILTER (WHERE NOT k)::BIGINT AS credits, sum(n_chars) FILTER (WHERE NOT k)::BIGINT AS new_comments, 0::BIGINT AS refreshed_comments
    FROM (SELECT *, doc_id % 7 = 0 AS k, doc_id % 2 = 0 AS c, doc_id % 4 AS n FROM documents)""")
def run_counters(spark, sf_dir):
    items = _docs(spark, sf_dir).select(F.when(F.col("doc_id") % 2 == 0, "cheap").otherwise("full").alias("route"), F.when(F.col("doc_id") % 7 == 0, True).alias("skipped"), (F.col("doc_id") % 4).alias("calls"), (F.col("doc_id") % 4 * 2).alias("credits"), F.col("n_chars").alias("new_comments"), F.lit(0).cast("bigint").alias("refreshed_comments"))
    return fetch.counters(items)


@query("SELECT doc_id, CASE WHEN doc_id % 6 IN (1, 2) OR doc_id % 6 = 5 THEN 'retry' WHEN doc_id % 6 IN (3, 4) THEN 'failed' ELSE 'ok' END AS outcome FROM documents")
def response_outcome(spark, sf_dir):
    """How landed responses are treated, by status and body."""
    status = F.element_at(F.array(*map(F.lit, (200, 429, 503, 403, 404, 200))), (F.col("doc_id") % 6 + 1).cast("int"))
    return _docs(spark, sf_dir).select("doc_id", X.fetch_outcome(status, F.when(F.col("doc_id") % 6 == 5, "You have been Blocked by network security").otherwise("")).alias("outcome"))


# ---------------------------------------------------------------- classification

_RESULTS = "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'errored' WHEN 1 THEN 'no_tool_use_block' ELSE 'succeeded' END AS status, n_chars AS n FROM documents"


def _results(spark, sf_dir):
    """Landed results of a batch: answers, failures, and successes without an answer."""
    d = F.col("doc_id")
    answer = F.concat(F.lit('{"type":"tool_use","input":{"classifications":[{"comment_id":"c'), d, F.lit('","relevance_tag":"none","confidence":"low"}]}}'))
    content = F.when(d % 4 == 1, F.lit('{"type":"text"}')).otherwise(F.concat(F.lit('{"type":"text"},'), answer))
    whole = F.concat(F.lit('{"custom_id":"k'), d, F.lit('","result":{"type":"'), F.when(d % 4 == 0, "errored").otherwise("succeeded"), F.lit('","message":{"usage":{"input_tokens":'), "n_chars", F.lit(',"output_tokens":3},"content":['), content, F.lit("]}}}"))
    return classify.read_results(_docs(spark, sf_dir).select(whole.alias("payload")))


@query(f"SELECT 'k' || doc_id AS custom_id, status, CASE WHEN status = 'errored' THEN 0 ELSE n END AS input_tokens, CASE WHEN status = 'succeeded' THEN 'c' || doc_id END AS comment_id FROM ({_RESULTS})")
def batch_results(spark, sf_dir):
    return _results(spark, sf_dir).select("custom_id", "status", "input_tokens", F.try_element_at("classifications", F.lit(1))["comment_id"].alias("comment_id"))


@query(f"SELECT 'k' || doc_id AS custom_id, status AS error FROM ({_RESULTS}) WHERE status <> 'succeeded'")
def batch_errors(spark, sf_dir):
    return classify.errors(_results(spark, sf_dir))


@query(f"SELECT sum(CASE WHEN status = 'errored' THEN 0 ELSE n END)::BIGINT AS input_tokens, sum(CASE WHEN status = 'errored' THEN 0 ELSE 3 END)::BIGINT AS output_tokens, count(*) FILTER (WHERE status <> 'succeeded')::BIGINT AS failed FROM ({_RESULTS})")
def batch_usage(spark, sf_dir):
    return classify.usage(_results(spark, sf_dir))


@query("SELECT 'c' || doc_id AS comment_id FROM documents WHERE doc_id % 4 NOT IN (2, 3)")
def unclassified(spark, sf_dir):
    """Comments without an answer."""
    answers = _results(spark, sf_dir).select("custom_id", F.explode("classifications").alias("a")).select("custom_id", "a.*")
    all_ = _docs(spark, sf_dir).select(F.concat(F.lit("c"), "doc_id").alias("comment_id"))
    return classify.unclassified(classify.attach(all_, answers, seq="custom_id")).select("comment_id")


@query("SELECT 'c' || conv_id || '_' || turn AS comment_id FROM conversations WHERE conv_id % 3 = 0")
def requested_only(spark, sf_dir):
    """Comments of a sample's requests."""
    manifest = comments(spark, sf_dir).groupBy("thread_id").agg(F.collect_list("comment_id").alias("comment_ids")).filter(F.substring("thread_id", 2, 20).cast("bigint") % 3 == 0)
    return classify.only_requested(comments(spark, sf_dir), manifest).select("comment_id")


@query("SELECT 't' || conv_id AS thread_id, 'c' || conv_id || '_' || turn AS comment_id, turn + 1 AS visit, n > 3 AS truncated FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) WHERE turn < 3")
def comment_cap(spark, sf_dir):
    """The first three comments of each thread, in the order of the walk."""
    from ..sources import jsontree
    from .registry import _json_pages

    out = jsontree.assemble(_json_pages(spark, sf_dir, 4), max_comments=3)
    return out.select("thread_id", "comment_id", F.col("visit").cast("bigint").alias("visit"), "truncated")


@query("SELECT 't' || conv_id AS thread_id, 'c' || conv_id || '_' || turn AS comment_id, n > 4 AS truncated FROM (SELECT *, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations) WHERE turn < 4")
def page_cap(spark, sf_dir):
    """The first page of each thread."""
    from ..sources import jsontree
    from .registry import _json_pages

    return jsontree.assemble(_json_pages(spark, sf_dir, 4), max_pages=1).select("thread_id", "comment_id", "truncated")
