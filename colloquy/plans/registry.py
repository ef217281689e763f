"""Queries of the reference operators over the driver's tables, and DuckDB SQL with the same columns.

conversations stand for threads (one row a comment), documents for posts, pages
for landed HTML, labels for labelling runs, events for sightings in time, orders
and customer for state and incoming rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import urls as U
from ..operators import classify, compare, discover, state, tree
from ..session import table
from ..sources import html, jsontree

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
CONTEXT = 3
CHUNK = 3
KEYWORDS = ["ción", "être", "für", "the of", "QUÉ", "und", "heit", "èment", "ñas", "tion and"]
CUTOFF = 1705276800.0


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def comments(spark: SparkSession, sf_dir: str, shape: str = "branch") -> DataFrame:
    """conversations as comments: a chain, or a tree in which turn k replies to turn (k - 1) div 2."""
    up: Column = F.col("turn") - 1 if shape == "chain" else F.floor((F.col("turn") - 1) / 2)
    c = table(spark, sf_dir, "conversations")
    return c.select(
        F.concat(F.lit("t"), "conv_id").alias("thread_id"),
        F.concat(F.lit("p"), "conv_id").alias("post_id"),
        (F.col("conv_id") * 100000 + F.col("turn")).alias("seq"),
        F.concat(F.lit("c"), "conv_id", F.lit("_"), "turn").alias("comment_id"),
        F.when(F.col("turn") == 0, F.concat(F.lit("p"), "conv_id")).otherwise(F.concat(F.lit("c"), "conv_id", F.lit("_"), up.cast("bigint"))).alias("parent_id"),
        F.col("role").alias("author"),
        F.coalesce("text", F.lit("")).alias("body"),
        F.lit(0).alias("depth"),
        F.floor(F.log2(F.col("turn") + 1)).cast("int").alias("level"),
        F.concat(F.lit("Thread "), "conv_id").alias("thread_title"),
        F.lit("").alias("thread_body"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as posts; the first line is the title."""
    return table(spark, sf_dir, "documents").withColumn("title", F.substring_index(F.coalesce("text", F.lit("")), "\n", 1))


_TREE = """
    WITH RECURSIVE c AS (SELECT conv_id, turn, role, coalesce(text, '') AS body, {up} AS p FROM conversations),
    l AS (
        SELECT conv_id, turn, p AS cur, CASE WHEN p IS NULL THEN []::BIGINT[] ELSE [p] END AS anc FROM c
        UNION ALL
        SELECT l.conv_id, l.turn, c.p, list_prepend(c.p, l.anc) FROM l JOIN c ON c.conv_id = l.conv_id AND c.turn = l.cur WHERE c.p IS NOT NULL),
    best AS (SELECT conv_id, turn, max_by(anc, len(anc)) AS anc FROM l GROUP BY ALL),
    each AS (SELECT conv_id, turn, len(anc) AS n, unnest(anc) AS a, generate_subscripts(anc, 1) AS pos FROM best),
    told AS (
        SELECT e.conv_id, e.turn, string_agg('c' || e.conv_id || '_' || e.a, '>' ORDER BY e.pos) AS ids,
               string_agg(c.role || ': ' || c.body, chr(10) ORDER BY e.pos) FILTER (WHERE e.pos > e.n - {k}) AS context
        FROM each e JOIN c ON c.conv_id = e.conv_id AND c.turn = e.a GROUP BY ALL)
    SELECT 't' || c.conv_id AS thread_id, 'c' || c.conv_id || '_' || c.turn AS comment_id, len(b.anc)::BIGINT AS depth,
           'c' || c.conv_id || '_' || coalesce(b.anc[1], c.turn) AS root_comment_id, coalesce(t.ids, '') AS ancestor_ids,
           coalesce(up.body, '') AS parent_body, coalesce(t.context, '') AS context_text
    FROM c JOIN best b USING (conv_id, turn) LEFT JOIN told t USING (conv_id, turn) LEFT JOIN c up ON up.conv_id = c.conv_id AND up.turn = c.p"""
_CHAIN = _TREE.format(up="CASE WHEN turn > 0 THEN turn - 1 END", k=CONTEXT)
_BRANCH = _TREE.format(up="CASE WHEN turn > 0 THEN (turn - 1) // 2 END", k=CONTEXT)


def _enriched(spark, sf_dir, shape):
    out = tree.enrich_context(comments(spark, sf_dir, shape), CONTEXT)
    return out.select("thread_id", "comment_id", F.col("depth").cast("bigint").alias("depth"), "root_comment_id", "ancestor_ids", "parent_body", "context_text")


@query(_CHAIN)
def context_enrich_chain(spark, sf_dir):
    return _enriched(spark, sf_dir, "chain")


@query(_BRANCH)
def context_enrich_branch(spark, sf_dir):
    return _enriched(spark, sf_dir, "branch")


_LEVELS = "SELECT conv_id, turn, floor(log2(turn + 1))::BIGINT AS d FROM conversations"


@query(f"""
    WITH c AS ({_LEVELS}),
    last AS (SELECT a.conv_id, a.turn, a.d, max(b.turn) AS j FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id AND b.turn < a.turn AND b.d < a.d GROUP BY ALL)
    SELECT 't' || last.conv_id AS thread_id, 'c' || last.conv_id || '_' || last.turn AS comment_id,
           CASE WHEN last.d = 0 THEN 'p' || last.conv_id WHEN c.d = last.d - 1 THEN 'c' || c.conv_id || '_' || c.turn ELSE '' END AS parent_id
    FROM last LEFT JOIN c ON c.conv_id = last.conv_id AND c.turn = last.j""")
def depth_stack_parent(spark, sf_dir):
    return tree.depth_stack_parents(comments(spark, sf_dir), depth="level")


_CHUNKS = f"""
    WITH c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n FROM conversations),
    g AS (SELECT *, dense_rank() OVER (ORDER BY conv_id, n // {CHUNK}) - 1 AS chunk, n % {CHUNK} AS place FROM c)"""


@query(f"{_CHUNKS} SELECT 'c' || conv_id || '_' || turn AS comment_id, chunk::BIGINT AS chunk, place::BIGINT AS place FROM g")
def chunk_by_thread(spark, sf_dir):
    out = classify.chunk_by_thread(comments(spark, sf_dir), CHUNK)
    return out.select("comment_id", F.col("chunk").cast("bigint").alias("chunk"), F.col("place").cast("bigint").alias("place"))


def _chunked(spark, sf_dir):
    rows = comments(spark, sf_dir)
    above = rows.select(F.col("comment_id").alias("pc"), F.col("body").alias("parent_body"))
    rows = rows.withColumn("depth", F.col("level")).join(above, F.col("pc") == F.col("parent_id"), "left")
    return classify.chunk_by_thread(rows.withColumn("context_text", F.concat(F.lit("of "), "thread_id")), CHUNK)


@query(f"""{_CHUNKS},
    r AS (SELECT g.*, floor(log2(g.turn + 1))::BIGINT AS d, trim(coalesce(up.text, ''), chr(10) || chr(32)) AS ptext FROM g
          LEFT JOIN conversations up ON up.conv_id = g.conv_id AND up.turn = (g.turn - 1) // 2 AND g.turn > 0)
    SELECT 'chunk_' || chunk || '_t' || conv_id AS custom_id,
           'Thread: Thread ' || conv_id || chr(10) || chr(10) || 'Comments:' || chr(10) || string_agg(
             '[c' || conv_id || '_' || turn || '] (depth ' || d || ')' || CASE WHEN d >= 2 THEN chr(10) || '    Thread root: of t' || conv_id ELSE '' END
             || CASE WHEN d >= 1 AND ptext <> '' THEN chr(10) || '    Replying to: ' || CASE WHEN length(ptext) > 60 THEN rtrim(substring(ptext, 1, 60), chr(10) || chr(32)) || '...' ELSE ptext END ELSE '' END
             || chr(10) || '    Comment: ' || coalesce(text, ''), chr(10) ORDER BY place) AS user_content,
           string_agg('c' || conv_id || '_' || turn, ',' ORDER BY place) AS comment_ids
    FROM r GROUP BY chunk, conv_id""")
def render_prompt(spark, sf_dir):
    out = classify.render_requests(_chunked(spark, sf_dir), 60)
    return out.select("custom_id", "user_content", F.array_join("comment_ids", ",").alias("comment_ids"))


_KW = "(VALUES " + ", ".join(f"({i}, '{k}')" for i, k in enumerate(KEYWORDS)) + ") k(s, keyword)"
_HITS = f"SELECT doc_id, s, keyword FROM documents, {_KW} WHERE contains(lower(strip_accents(coalesce(text, ''))), lower(strip_accents(keyword)))"


def _hits(spark, sf_dir):
    return discover.match_keywords(table(spark, sf_dir, "documents"), KEYWORDS, "text").select("doc_id", "kw_seq", "keyword")


@query(f"SELECT doc_id, s::BIGINT AS kw_seq, keyword FROM ({_HITS})")
def keyword_match(spark, sf_dir):
    return _hits(spark, sf_dir).withColumn("kw_seq", F.col("kw_seq").cast("bigint"))


@query(f"SELECT doc_id, string_agg(keyword, '; ' ORDER BY s) AS matched_keyword FROM ({_HITS}) GROUP BY doc_id")
def keyword_terms_ordered(spark, sf_dir):
    return discover.keywords_in_order(_hits(spark, sf_dir), "doc_id")


@query(f"SELECT doc_id, string_agg(keyword, '; ' ORDER BY keyword) AS matched_keyword FROM ({_HITS}) GROUP BY doc_id")
def keyword_terms_sorted(spark, sf_dir):
    return discover.keywords_sorted(_hits(spark, sf_dir), "doc_id")


@query(f"SELECT doc_id, arg_min(keyword, s) AS matched_keyword FROM ({_HITS}) GROUP BY doc_id")
def keyword_first_wins(spark, sf_dir):
    return discover.keyword_first(_hits(spark, sf_dir), "doc_id")


@query(f"""
    WITH e AS (SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN 0 ELSE epoch(ts) END AS created FROM events)
    SELECT event_id, created IS NULL AS undated FROM e WHERE created IS NULL OR created = 0 OR created >= {CUTOFF}""")
def recency_filter(spark, sf_dir):
    created = F.when(F.col("event_type") == "signup", F.lit(0.0)).when(F.col("event_type") != "error", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)
    rows = table(spark, sf_dir, "events").select("event_id", created.alias("created"))
    return rows.filter(discover.recent("created", CUTOFF)).select("event_id", F.col("created").isNull().alias("undated"))


@query("""
    SELECT o.o_orderkey, coalesce(l.n, 0)::BIGINT AS num_comments FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
    WHERE coalesce(l.n, 0) >= 4""")
def min_count_filter(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    rows = table(spark, sf_dir, "orders").join(n, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rows.filter(discover.at_least("n", 4)).select("o_orderkey", F.coalesce("n", F.lit(0)).alias("num_comments"))


@query("""
    WITH fresh AS (SELECT * FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'))
    SELECT o_orderkey, o_custkey FROM fresh QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 2""")
def new_posts_capped(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    known = orders.filter("o_orderpriority = '1-URGENT'")
    return discover.new_capped(orders, known, "o_custkey", "o_custkey", ["o_orderdate", "o_orderkey"], 2).select("o_orderkey", "o_custkey")


@query("""
    WITH k AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'), i AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus <> 'F')
    SELECT count(*) FILTER (WHERE k.o_custkey IS NULL)::BIGINT AS new_count, count(k.o_custkey)::BIGINT AS refreshed_count FROM i LEFT JOIN k USING (o_custkey)""")
def new_vs_refreshed_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return state.new_and_refreshed(orders.filter("o_orderstatus <> 'F'"), orders.filter("o_orderstatus = 'F'"), "o_custkey")


@query("""
    WITH base AS (SELECT 'C' || c_custkey AS id, c_acctbal AS amount, c_mktsegment AS kind, c_custkey AS seq FROM customer),
    incoming AS (
        SELECT 'C' || o_custkey AS id, o_totalprice AS amount, o_orderstatus AS kind, o_orderkey AS seq FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL SELECT 'S' || s_suppkey, s_acctbal, 'supplier', s_suppkey FROM supplier),
    b AS (SELECT *, 0 AS fresh FROM base UNION ALL SELECT *, 1 FROM incoming)
    SELECT id, amount, kind FROM b QUALIFY row_number() OVER (PARTITION BY id ORDER BY fresh DESC, seq DESC) = 1""")
def upsert_whole_row(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_mktsegment").alias("kind"), F.col("c_custkey").alias("seq"))
    urgent = table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    incoming = urgent.select(F.concat(F.lit("C"), "o_custkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("kind"), F.col("o_orderkey").alias("seq"))
    suppliers = table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("id"), F.col("s_acctbal").alias("amount"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("seq"))
    return state.upsert_rows(base, incoming.unionByName(suppliers), "id", "seq").select("id", "amount", "kind")


_SIGHT = "SELECT 'u' || user_id AS id, event_id AS first_seen, event_id AS last_seen, event_type AS kind FROM events"


@query(f"SELECT id, min(first_seen) AS first_seen, max(last_seen) AS last_seen, arg_max(kind, last_seen) AS kind FROM ({_SIGHT}) GROUP BY id")
def upsert_first_seen(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("id"), F.col("event_id").alias("first_seen"), F.col("event_id").alias("last_seen"), F.col("event_type").alias("kind"), "ts")
    early = rows.filter("ts < timestamp'2024-01-16'").drop("ts")
    base = state.upsert_keeping_first(early.limit(0), early, "id", "first_seen", "last_seen")
    return state.upsert_keeping_first(base, rows.filter("ts >= timestamp'2024-01-16'").drop("ts"), "id", "first_seen", "last_seen")


@query("""
    SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus <> 'F' AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def insert_only_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return state.insert_only(orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'"), "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY coalesce(text, '')")
def dedup_first(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return discover.keep_first(rows, "h", "doc_id").select("doc_id", "source")


@query("SELECT user_id, min(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def dedup_last(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    return discover.keep_last(rows, "user_id", "event_id")


@query("""
    WITH r AS (SELECT source || '/' || lang AS post_id, split_part(coalesce(text, ''), chr(10), 1) AS title, CASE WHEN contains(coalesce(text, ''), 'License') THEN source ELSE '' END AS author,
                      CASE WHEN n_chars > 1000 THEN n_chars::DOUBLE END AS created_utc, n_chars AS num_comments, n_chars > 20000 AS is_stickied, doc_id AS seq FROM documents)
    SELECT post_id, first(title ORDER BY length(title) DESC, seq) AS title, arg_min(author, seq) FILTER (WHERE author <> '') AS author, arg_min(created_utc, seq) FILTER (WHERE created_utc IS NOT NULL) AS created_utc,
           max(num_comments) AS num_comments, bool_or(is_stickied) AS is_stickied, min(seq) AS seq FROM r GROUP BY post_id""")
def merge_richest(spark, sf_dir):
    rows = posts(spark, sf_dir).select(
        F.concat_ws("/", "source", "lang").alias("post_id"), "title", F.when(F.contains("text", F.lit("License")), F.col("source")).otherwise("").alias("author"),
        F.when(F.col("n_chars") > 1000, F.col("n_chars").cast("double")).alias("created_utc"), F.col("n_chars").alias("num_comments"), (F.col("n_chars") > 20000).alias("is_stickied"), F.col("doc_id").alias("seq"),
    )
    return discover.merge_richest(rows)


@query("SELECT d.doc_id, coalesce(l.quality::VARCHAR, '') AS quality, coalesce(l.toxic::VARCHAR, '') AS toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def attach_labels(spark, sf_dir):
    return classify.attach(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"), key="doc_id")


_RUNS = """
    WITH a AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' END AS tag, toxic::VARCHAR AS icp FROM labels),
    b AS (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 'good' WHEN n_chars > 500 THEN 'none' END AS tag, CASE WHEN contains(coalesce(text, ''), 'idiot') THEN '1' ELSE '0' END AS icp FROM documents),
    m AS (SELECT doc_id, a.tag AS tag_a, b.tag AS tag_b, a.icp AS icp_a, b.icp AS icp_b FROM a JOIN b USING (doc_id))"""


def _runs(spark, sf_dir):
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    a = labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("").alias("tag"), F.col("toxic").cast("string").alias("icp"))
    b = docs.select("doc_id", F.when(F.col("n_chars") > 1000, "good").when(F.col("n_chars") > 500, "none").otherwise("N/A").alias("tag"), F.when(F.contains("text", F.lit("idiot")), "1").otherwise("0").alias("icp"))
    return compare.pair_up(compare.with_missing(a), compare.with_missing(b), "doc_id", ["tag", "icp"], ("a", "b"))


@query(f"""{_RUNS} SELECT count(*)::BIGINT AS n, count(*) FILTER (WHERE tag_a = tag_b)::BIGINT AS tag_agree, round(100.0 * count(*) FILTER (WHERE tag_a = tag_b) / nullif(count(*), 0), 1) AS tag_percent,
    count(*) FILTER (WHERE icp_a = icp_b)::BIGINT AS icp_agree, round(100.0 * count(*) FILTER (WHERE icp_a = icp_b) / nullif(count(*), 0), 1) AS icp_percent FROM m""")
def label_compare(spark, sf_dir):
    return compare.agreement(_runs(spark, sf_dir), ["tag", "icp"], ("a", "b"))


@query(f"{_RUNS} SELECT * FROM m WHERE NOT coalesce(tag_a = tag_b, false) OR NOT coalesce(icp_a = icp_b, false)")
def label_disagreements(spark, sf_dir):
    return compare.disagreements(_runs(spark, sf_dir), ["tag", "icp"], ("a", "b"))


@query(f"{_RUNS} SELECT tag_b AS label, count(*)::BIGINT AS label_count FROM m WHERE tag_b IS NOT NULL GROUP BY 1")
def label_distribution(spark, sf_dir):
    return compare.distribution(_runs(spark, sf_dir), "tag_b")


@query("""
    WITH r AS (SELECT conv_id, sum(length(coalesce(text, ''))) AS i, count(*) * 20 AS o, count(*) >= 3 AS good FROM conversations GROUP BY 1),
    u AS (SELECT sum(CASE WHEN good THEN i ELSE 0 END)::BIGINT AS input_tokens, sum(CASE WHEN good THEN o ELSE 0 END)::BIGINT AS output_tokens, count(*) FILTER (WHERE NOT good)::BIGINT AS failed FROM r)
    SELECT *, round(input_tokens / 1e6 * 1.0 + output_tokens / 1e6 * 5.0, 4) AS dollars FROM u""")
def usage_cost(spark, sf_dir):
    r = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sum(F.length(F.coalesce("text", F.lit("")))).alias("input_tokens"), (F.count("*") * 20).alias("output_tokens"), F.when(F.count("*") >= 3, "succeeded").otherwise("errored").alias("status"))
    return classify.usage(r).withColumn("dollars", classify.cost("input_tokens", "output_tokens", "larger"))


@query(r"""SELECT doc_id, trim(regexp_replace(coalesce(text, ''), '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')) AS cleaned FROM documents""")
def clean_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_text("text").alias("cleaned"))


@query("SELECT doc_id, coalesce(try_cast(replace(regexp_extract(coalesce(text, ''), '-?[0-9,]+'), ',', '') AS BIGINT), -1) AS number FROM documents")
def parse_int(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.parse_int("text", -1).alias("number"))


@query("""
    SELECT event_id, epoch_us(ts) / 1e6 AS created_utc, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS created_iso FROM events""")
def iso_time(spark, sf_dir):
    created = X.parse_created(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
    return table(spark, sf_dir, "events").select("event_id", created.alias("created_utc"), X.to_iso(created).alias("created_iso"))


@query("""
    WITH d AS (SELECT doc_id, CASE WHEN lang = 'en' THEN 't3_' WHEN lang = 'de' THEN 't1_' ELSE '' END || 'Ab' || doc_id AS id FROM documents)
    SELECT doc_id, regexp_replace(id, '^t[13]_', '') AS bare, lower(regexp_replace(id, '^t[13]_', '')) AS normal, CASE WHEN regexp_matches(id, '^t[13]_') THEN id ELSE 't3_' || id END AS fullname FROM d""")
def fullname_ids(spark, sf_dir):
    name = F.concat(F.when(F.col("lang") == "en", "t3_").when(F.col("lang") == "de", "t1_").otherwise(""), F.lit("Ab"), "doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", X.strip_fullname(name).alias("bare"), X.normalize_post_id(name).alias("normal"), X.to_fullname(name).alias("fullname"))


@query("SELECT doc_id, base64(encode('t3_' || doc_id)) AS after FROM documents")
def cursor_b64(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.after_cursor(F.col("doc_id").cast("string")).alias("after"))


@query(r"""SELECT page_id, lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1)) AS host, CASE WHEN regexp_matches(url, '^[a-zA-Z]+://') THEN url ELSE 'https://www.reddit.com/' || url END AS whole,
    regexp_extract(replace(url, '/en/', '/comments/'), '/comments/([^/?#]+)', 1) AS post_id FROM pages""")
def url_parts(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", U.host_of(url).alias("host"), U.modern_url(url).alias("whole"), U.post_id(F.replace(url, F.lit("/en/"), F.lit("/comments/"))).alias("post_id"))


@query("""
    WITH e AS (SELECT event_id, user_id, day(ts)::BIGINT AS page, value < 1 AS old FROM events), s AS (SELECT user_id, min(page) FILTER (WHERE old) AS stop FROM e GROUP BY 1)
    SELECT event_id, user_id, page FROM e JOIN s USING (user_id) WHERE stop IS NULL OR page <= stop""")
def stop_page(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.dayofmonth("ts").cast("bigint").alias("page"), "value")
    return discover.stop_pages(e, "user_id", "page", F.col("value") < 1).select("event_id", "user_id", "page")


@query("""
    WITH o AS (SELECT o_custkey, o_orderkey, length(o_orderpriority)::BIGINT AS calls, 20 - coalesce(sum(length(o_orderpriority)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining FROM orders)
    SELECT o_orderkey, remaining::BIGINT AS remaining, greatest(least(calls, remaining), 0)::BIGINT AS granted FROM o WHERE remaining > 0""")
def running_budget(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("calls", F.length("o_orderpriority").cast("bigint"))
    return discover.within_budget(o, "o_custkey", ["o_orderdate", "o_orderkey"], "calls", 20).select("o_orderkey", "remaining", "granted")


@query("""
    WITH c AS (SELECT 't' || conv_id AS thread_id, 'c' || conv_id || '_' || turn AS comment_id, CASE role WHEN 'user' THEN NULL ELSE turn END AS created, floor(log2(turn + 1))::BIGINT AS d FROM conversations)
    SELECT thread_id, comment_id, row_number() OVER (PARTITION BY thread_id ORDER BY coalesce(created, 0), d, comment_id)::BIGINT AS place FROM c""")
def output_order_rank(spark, sf_dir):
    from pyspark.sql import Window

    c = comments(spark, sf_dir).withColumn("created_utc", F.when(F.col("author") != "user", F.col("seq") % 100000))
    place = F.row_number().over(Window.partitionBy("thread_id").orderBy(*discover.output_order(depth="level")))
    return c.select("thread_id", "comment_id", place.cast("bigint").alias("place"))


@query("SELECT doc_id, lang, source FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 100")
def seeded_sample(spark, sf_dir):
    return discover.seeded_sample(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), "doc_id", 100, 7)


_PLAIN = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '[\\s\\x{{85}}\\p{{Z}}]+', ' ', 'g'))"


@query(f"""SELECT page_id, {_PLAIN.format("regexp_extract(html, '<title>(.*?)</title>', 1, 's')")} AS title, {_PLAIN.format("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS h1,
    len(regexp_extract_all(html, '<a [^>]*href="[^"]')) AS links FROM pages""")
def parse_pages(spark, sf_dir):
    return html.page_facts(table(spark, sf_dir, "pages").select("page_id", "html"), ["page_id"])


def _escaped(c: str) -> Column:
    out = F.col(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


@query(f"""
    WITH c AS ({_LEVELS}),
    last AS (SELECT a.conv_id, a.turn, a.d, max(b.turn) AS j FROM c a LEFT JOIN c b ON b.conv_id = a.conv_id AND b.turn < a.turn AND b.d < a.d GROUP BY ALL)
    SELECT 'p' || last.conv_id AS post_id, 'c' || last.conv_id || '_' || last.turn AS comment_id, last.d AS depth, t.role AS author,
           CASE WHEN last.d = 0 THEN 'p' || last.conv_id WHEN c.d = last.d - 1 THEN 'c' || c.conv_id || '_' || c.turn ELSE '' END AS parent_id,
           trim(regexp_replace(t.text, '[\\s\\x0b\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+', ' ', 'g')) AS body
    FROM last LEFT JOIN c ON c.conv_id = last.conv_id AND c.turn = last.j JOIN conversations t ON t.conv_id = last.conv_id AND t.turn = last.turn""")
def html_thread_parse(spark, sf_dir):
    """Threads rendered to flat pages without parent ids, then parsed back."""
    c = comments(spark, sf_dir)
    one = F.concat(F.lit('<shreddit-comment thingid="t1_'), "comment_id", F.lit('" depth="'), "level", F.lit('" author="'), "author", F.lit('"><div slot="comment"><p>'), _escaped("body"), F.lit("</p></div></shreddit-comment>"))
    page = c.groupBy("post_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", one.alias("x")))), lambda x: x["x"]), "\n").alias("html"))
    out = html.thread_rows(page, ["post_id"], include_deleted=True)
    return out.select("post_id", "comment_id", F.col("depth").cast("bigint").alias("depth"), "author", "parent_id", "body")


def _json_pages(spark, sf_dir, size: int) -> DataFrame:
    """Landed comment pages of `size` comments, each with the cursor of the next; odd places are replies to the one before."""
    c = comments(spark, sf_dir).select("thread_id", "comment_id", "author", "body", (F.col("seq") % 100000).alias("turn"), F.count("*").over(_thread()).alias("n"))
    c = c.withColumn("page", F.floor(F.col("turn") / size))
    parts = c.groupBy("thread_id", "page", "n").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("comment_id").alias("id"), F.col("author"), F.col("body").alias("text")))).alias("r"))
    roots = F.transform(F.filter("r", lambda x: x["turn"] % 2 == 0), lambda x: F.struct(x["id"].alias("id"), x["author"].alias("author"), x["text"].alias("text"), F.struct(F.filter("r", lambda y: y["turn"] == x["turn"] + 1).alias("items")).alias("replies")))
    more = (F.col("page") + 1) * size < F.col("n")
    page = F.to_json(F.struct(roots.alias("comments"), F.struct(more.alias("hasMore"), F.when(more, (F.col("page") + 1).cast("string")).alias("nextCursor")).alias("page")))
    return parts.select("thread_id", F.when(F.col("page") > 0, F.col("page").cast("string")).alias("cursor"), page.alias("payload"))


def _thread():
    from pyspark.sql import Window

    return Window.partitionBy("thread_id")


@query("SELECT 't' || conv_id AS thread_id, 'c' || conv_id || '_' || turn AS comment_id, (turn % 2)::BIGINT AS depth, turn AS seq FROM conversations")
def json_tree_flatten(spark, sf_dir):
    out = jsontree.flatten(_json_pages(spark, sf_dir, 100000), ["thread_id"])
    return out.select("thread_id", "comment_id", F.col("depth").cast("bigint").alias("depth"), "seq")


@query("SELECT 't' || conv_id AS thread_id, 'c' || conv_id || '_' || turn AS comment_id, (turn % 2)::BIGINT AS depth, turn + 1 AS visit, false AS truncated FROM conversations")
def json_tree_assemble(spark, sf_dir):
    out = jsontree.assemble(_json_pages(spark, sf_dir, 4))
    return out.select("thread_id", "comment_id", F.col("depth").cast("bigint").alias("depth"), F.col("visit").cast("bigint").alias("visit"), "truncated")


@query("SELECT event_id, coalesce(json_extract_string(props, '$.missing'), json_extract_string(props, '$.k')) AS first_value FROM events")
def json_first_match(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", X.first_present("props", "missing", "k").alias("first_value"))


@query("""
    WITH e AS (SELECT 'r' || user_id AS run_id, event_id AS seq, CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'running' END AS status, user_id AS post_count, event_id AS new_comment_count FROM events),
    l AS (SELECT run_id, arg_max(status, seq) AS status, arg_max(post_count, seq) AS post_count, arg_max(new_comment_count, seq) AS new_comment_count, min(seq) AS started, max(seq) AS updated FROM e GROUP BY 1)
    SELECT run_id, CASE WHEN status = 'running' AND started < (SELECT max(started) FROM l) THEN 'interrupted' ELSE status END AS status, post_count, new_comment_count, started, updated FROM l""")
def run_ledger(spark, sf_dir):
    status = F.when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed").otherwise("running")
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("r"), "user_id").alias("run_id"), F.col("event_id").alias("seq"), status.alias("status"), F.col("user_id").alias("post_count"), F.col("event_id").alias("new_comment_count"))
    return state.run_view(e)


@query("""
    WITH s AS (SELECT CASE WHEN lang = 'en' THEN 't3_' ELSE '' END || doc_id AS post_id, source FROM documents UNION ALL SELECT 't3_' || doc_id, 'other' FROM documents WHERE lang = 'de'),
    w AS (SELECT doc_id::VARCHAR AS wanted FROM labels)
    SELECT wanted, post_id, source FROM w JOIN s ON s.post_id IN (wanted, 't3_' || wanted) QUALIFY row_number() OVER (PARTITION BY wanted ORDER BY post_id <> wanted) = 1""")
def state_lookup(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    kept = d.select(F.concat(F.when(F.col("lang") == "en", "t3_").otherwise(""), F.col("doc_id").cast("string")).alias("post_id"), "source")
    kept = kept.unionByName(d.filter("lang = 'de'").select(F.concat(F.lit("t3_"), "doc_id").alias("post_id"), F.lit("other").alias("source")))
    return state.lookup_posts(kept, table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("post_id"))).select("wanted", "post_id", "source")


@query("""
    SELECT doc_id, CASE WHEN source <> 'src0' AND l.quality IS NOT NULL AND n_chars < 1000 THEN 'cheap' ELSE 'full' END AS route FROM documents LEFT JOIN labels l USING (doc_id)""")
def fetch_route(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    rows = rows.select("doc_id", F.when(F.col("source") == "src0", "repair").otherwise("full_scrape").alias("intake_mode"), F.when(F.col("quality").isNotNull(), F.col("n_chars")).alias("num_comments"))
    return rows.select("doc_id", discover.route(1000).alias("route"))


@query("""
    SELECT 't' || conv_id AS thread_id, 'c' || conv_id || '_' || turn AS comment_id, 'none' AS relevance_tag, ['1', '2A', '2B', '3', '4', 'none'][1 + m % 6] AS icp_likelihood,
           ['high', 'medium', 'low'][1 + m % 3] AS confidence, 'stub' AS rationale
    FROM (SELECT *, ('0x' || substr(md5('c' || conv_id || '_' || turn), 1, 8))::BIGINT AS m FROM conversations)""")
def classify_roundtrip(spark, sf_dir):
    """Requests rendered, answered by the deterministic stand-in, and joined back to every comment."""
    requests = classify.render_requests(_chunked(spark, sf_dir), 60)
    results = classify.classify(requests, classify.stub_model)
    answers = results.select("custom_id", F.explode("classifications").alias("a")).select("custom_id", "a.*")
    return classify.attach(comments(spark, sf_dir).select("thread_id", "comment_id"), answers, seq="custom_id")


from . import registry_flows  # noqa: E402,F401  its queries join those above
