import unicodedata

import pytest
from pyspark.sql import functions as F

from colloquy.functions import text as X
from colloquy.operators import discover as D
from colloquy.operators import state as S


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_caps_come_after_deduplication(spark):
    candidates = spark.createDataFrame([(k, "s", p) for k, p in enumerate(["old1", "new1", "old2", "new2", "new3"])], "seq long, source string, post_id string")
    known = spark.createDataFrame([("t3_OLD1",), ("old2",)], "post_id string")
    assert [r.post_id for r in D.new_capped(candidates, known, "post_id", "source", ["seq"], 2, normalized=True).orderBy("seq").collect()] == ["new1", "new2"]
    assert D.new_capped(candidates, known, "post_id", "source", ["seq"], 0).count() == 4


def test_recency_keeps_unknown_dates_and_the_cutoff_itself(spark):
    df = spark.createDataFrame([(1, None), (2, 0.0), (3, 99.0), (4, 100.0)], "id int, created_utc double")
    assert [r.id for r in df.filter(D.recent("created_utc", 100.0)).orderBy("id").collect()] == [1, 2, 4]
    assert df.filter(D.recent("created_utc", None)).count() == 4
    assert D.cutoff(1000.0, 0, True) is None and D.cutoff(1000.0, 0, False) == 1000.0 and D.cutoff(1e6, 2, True) == 1e6 - 172800


def test_keywords(spark):
    posts = spark.createDataFrame([(1, "Mi TARJETA y crédito"), (2, "credito"), (3, None)], "post_id int, title string")
    words = D.flatten_keywords({"a": [" crédito ", "tarjeta", ""], "b": ["crédito", "x"], "c": None})
    assert words == ["crédito", "tarjeta", "x"] and D.flatten_keywords({"a": [" x "]}, strip=False) == [" x "] and D.flatten_keywords({"a": ["x", "y"]}, limit=1) == ["x"]
    hits = D.match_keywords(posts, words)
    assert rows(hits.select("post_id", "keyword")) == [(1, "crédito"), (1, "tarjeta"), (2, "crédito")]
    assert rows(D.keywords_in_order(hits, "post_id")) == [(1, "crédito; tarjeta"), (2, "crédito")]
    assert rows(D.keyword_first(hits, "post_id")) == [(1, "crédito"), (2, "crédito")]
    reversed_ = hits.withColumn("kw_seq", -F.col("kw_seq"))
    assert rows(D.keywords_in_order(reversed_, "post_id"))[0] == (1, "tarjeta; crédito") and rows(D.keywords_sorted(reversed_, "post_id"))[0] == (1, "crédito; tarjeta")
    assert D.match_keywords(posts, [""]).count() == 3
    many = [*words, *(f"none{k}" for k in range(300)), "", "TARJETA"]
    assert rows(D.match_keywords(posts, many).select("post_id", "kw_seq", "keyword")) == sorted([(1, 0, "crédito"), (1, 1, "tarjeta"), (1, 304, "TARJETA"), (2, 0, "crédito"), (1, 303, ""), (2, 303, ""), (3, 303, "")], key=str)


def test_texts_go_to_python_by_the_hundred(spark):
    """Matching puts no batch of 10,000 texts into a worker, and folds as the plain definition does."""
    odd = ["", "ASCII Only", "Crème BRÛLÉE", "ﬁ ² ½ Å", "İ ΑΣ ς ß ẞ", "한국어 각", "नि à̖ ạ̈", "\ufdfa \U0001d400 e\u0301\u0327x", "ـً عربي", "A\x00\u02ff\u0300Z"]
    plain = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower() for t in odd]
    posts = spark.createDataFrame([(n, t, "x") for n, t in enumerate(odd)], "n int, title string, term string")
    assert [r[0] for r in posts.orderBy("n").select(X.normalize_for_match("title")).collect()] == plain
    for df in (D.match_keywords(posts, ["e"]), D.match_keywords(posts, [*(f"none{k}" for k in range(300)), "e"]), D.literal_hits(posts)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    for more in ([], [f"none{k}" for k in range(300)]):
        assert sorted(r.n for r in D.match_keywords(posts, ["é", *more]).collect()) == [n for n, t in enumerate(plain) if "e" in t]


def test_titles(spark):
    df = spark.createDataFrame([("12 comments", "share", "A  title"), ("1.2 votes", "", None), (None, "Real", "x")], "a string, b string, c string")
    assert [r[0] for r in df.select(D.title_of("a", "b", "c")).collect()] == ["A title", "", "Real"]


def test_richest_sighting(spark):
    sightings = [(0, "p", "Long title", "", None, 3, False), (1, "p", "Longer tit", "ann", 0.0, 9, None), (2, "p", "x", "bob", 5.0, 1, True)]
    df = spark.createDataFrame(sightings, "seq long, post_id string, title string, author string, created_utc double, num_comments int, is_stickied boolean")
    assert tuple(D.merge_richest(df).first()) == ("p", "Long title", "ann", 5.0, 9, True, 0)


def test_first_and_last_of_a_key(spark):
    df = spark.createDataFrame([(2, "a", "x"), (1, "a", "y"), (3, "b", "z")], "seq long, k string, v string")
    assert rows(D.keep_first(df, "k", "seq")) == [(1, "a", "y"), (3, "b", "z")]
    assert rows(D.keep_last(df, "k", "seq")) == [("a", 1, "x"), ("b", 3, "z")]


def test_routes_pages_and_budgets(spark):
    df = spark.createDataFrame([("full_scrape", 3), ("full_scrape", 20), ("full_scrape", None), ("repair", 3)], "intake_mode string, num_comments int")
    assert [r[0] for r in df.select(D.route(13)).collect()] == ["cheap", "full", "full", "full"]
    assert {r[0] for r in df.select(D.route(0)).collect()} == {"full"}
    pages = spark.createDataFrame([("a", 1, 0), ("a", 2, 1), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0)], "k string, page int, old int")
    assert D.stop_pages(pages, "k", "page", F.col("old") == 1).count() == 4 and D.stop_pages(pages, "k", "page", F.col("old") == 1, last_counts=False).count() == 2
    calls = spark.createDataFrame([("r", 1, 4), ("r", 2, 4), ("r", 3, 4)], "run string, seq int, calls int")
    assert [(r.seq, r.granted) for r in D.within_budget(calls, "run", ["seq"], "calls", 6).orderBy("seq").collect()] == [(1, 4), (2, 2)]
    assert D.within_budget(calls, "run", ["seq"], "calls", 0).count() == 3


def test_sample_is_seeded_and_whole(spark):
    df = spark.range(50)
    a, b, c = ([r.id for r in D.seeded_sample(df, "id", 20, s).collect()] for s in (1, 1, 2))
    assert a == b != c and len(set(a)) == 20 and D.seeded_sample(df, "id", 99, 1).count() == 50


def test_deleted_bodies(spark):
    df = spark.createDataFrame([("[deleted]",), ("ok",), (None,)], "body string")
    assert D.without_gone(df).count() == 1 and D.without_gone(df, include=True).count() == 3


def test_upsert_replaces_whole_rows_and_keeps_places(spark):
    schema = "id string, v string, w string, seq long"
    base = spark.createDataFrame([("a", "1", "x", 0), ("b", "2", "y", 1)], schema)
    new = spark.createDataFrame([("c", "3", "z", 0), ("a", "4", None, 1), (" ", "5", "q", 2), ("a", "6", None, 3), (None, "7", "q", 4)], schema)
    got = S.upsert_rows(base, new, "id", "seq").orderBy("place").collect()
    assert [(r.id, r.v, r.w) for r in got] == [("a", "6", None), ("b", "2", "y"), ("c", "3", "z")]


def test_state_keeps_the_first_sighting(spark):
    schema = "id string, first_seen_at string, last_seen_at string, title string"
    base = spark.createDataFrame([("a", "2024-01-01", "2024-01-02", "old")], schema)
    new = spark.createDataFrame([("a", "2024-02-01", "2024-02-01", "new"), ("b", "2024-02-01", "2024-02-01", "b"), ("", "x", "x", "x")], schema)
    assert rows(S.upsert_keeping_first(base, new, "id", "first_seen_at", "last_seen_at")) == [("a", "2024-01-01", "2024-02-01", "new"), ("b", "2024-02-01", "2024-02-01", "b")]


def test_insert_only_and_counts(spark):
    base, new = spark.createDataFrame([("a", 0)], "id string, seq long"), spark.createDataFrame([("b", 1), ("b", 0), ("a", 2)], "id string, seq long")
    assert rows(S.insert_only(base, new, "id", "seq")) == [("b", 0)]
    assert tuple(S.new_and_refreshed(new, base, "id").first()) == (1, 1)


def test_interrupted_runs(spark):
    events = spark.createDataFrame([("r1", 1, "running", 0, 0), ("r2", 2, "running", 0, 0), ("r2", 3, "completed", 5, 9), ("r3", 4, "running", 1, 1)], "run_id string, seq long, status string, post_count int, new_comment_count int")
    assert {r.run_id: r.status for r in S.run_view(events).collect()} == {"r1": "interrupted", "r2": "completed", "r3": "running"}


def test_lookup_prefers_the_exact_form(spark):
    known = spark.createDataFrame([("abc", "exact"), ("t3_abc", "full"), ("t3_x", "only")], "post_id string, v string")
    got = S.lookup_posts(known, spark.createDataFrame([("abc",), ("x",), ("gone",)], "post_id string"))
    assert {r.wanted: r.v for r in got.collect()} == {"abc": "exact", "x": "only"}


def test_versions(spark, tmp_path):
    S.write_version(spark.range(2), str(tmp_path), "1")
    S.write_version(spark.range(5), str(tmp_path), "2")
    assert S.read_version(spark, str(tmp_path)).count() == 5
    # a crash before the pointer leaves the version before; pointers are never replaced
    spark.range(9).write.parquet(f"{tmp_path}/v=3")
    assert S.read_version(spark, str(tmp_path)).count() == 5 and len(list(tmp_path.glob("pointer-*"))) == 2
    with pytest.raises(FileNotFoundError):
        S.read_version(spark, str(tmp_path / "none"))


def test_older_ids_come_in_once(spark):
    state = spark.createDataFrame([("a", "2024", 3)], "comment_id string, first_seen_at string, depth int")
    ids = spark.createDataFrame([(" a ",), ("b",), ("b",), ("",)], "comment_id string")
    once = S.import_ids(state, ids, "2025")
    assert rows(once) == rows(S.import_ids(once, ids, "2026")) == [("a", "2024", 3), ("b", "2025", None)]


def test_a_run_ledger(spark):
    events = spark.createDataFrame([], "run_id string, seq long, status string, post_count int, new_comment_count int, at string")
    events = S.finish_run(S.progress(S.start_run(events, "r1", 1, "t"), "r1", 2, 1, 5, "t"), "r1", 3, 2, 9, "t", failures=1)
    events = S.start_run(S.start_run(events, "r2", 4, "t"), "r3", 5, "t")
    assert rows(S.run_view(events).select("run_id", "status", "post_count")) == [("r1", "completed_with_errors", 2), ("r2", "interrupted", 0), ("r3", "running", 0)]
    assert S.run_view(S.finish_run(events, "r3", 6, 0, 0, "t", error="x")).filter("status = 'failed'").count() == 1


def listing(spark, rows):
    return spark.createDataFrame([("s", 0, *r) for r in rows], "source string, source_no int, page_no int, seq long, post_id string, created_utc double, is_stickied boolean")


def test_walks_over_listings(spark):
    df = listing(spark, [(1, 0, "pin", 1.0, True), (1, 1, "a", 9.0, False), (1, 2, "old", 1.0, False), (2, 0, "a", 9.0, False), (2, 1, "b", None, False), (3, 0, "old2", 2.0, True), (4, 0, "c", 9.0, False), (6, 0, "d", 9.0, False)])
    ids = lambda out: sorted(r.post_id for r in out.collect())
    assert ids(D.walk_listing(df, 5.0)) == ["a", "b"]  # page 3 has nothing recent
    assert ids(D.walk_listing(df, 5.0, stop_when_old=False)) == ["a", "b", "c"]  # page 5 has not landed
    assert ids(D.walk_listing(df, None, max_pages=3, skip_stickied=False)) == ["a", "b", "old", "old2", "pin"]
    assert ids(D.walk_listing(df, 5.0, stop_when_old=False, max_posts=2)) == ["a", "b"]
    assert ids(D.walk_feed(df, 5.0)) == ["a"]  # page 1 has an old row
    assert ids(D.walk_feed(df.filter("created_utc is null or created_utc = 9"), None)) == ["a", "b", "c", "d"]
    again = listing(spark, [(1, 0, "a", 9.0, False), (2, 0, "a", 9.0, False), (3, 0, "b", 9.0, False)])
    assert ids(D.walk_feed(again, None)) == ["a"]  # page 2 brings nothing new
    assert ids(D.walk_feed(again, None, max_pages=1)) == ["a"]


def test_searches_and_sources_merge_their_keywords(spark):
    df = spark.createDataFrame([("s", k, w, 1, n, p, None, False) for k, w, n, p in ((0, "z", 0, "a"), (0, "z", 1, "b"), (1, "y", 0, "a"), (1, "y", 1, "c"))], "source string, kw_seq int, keyword string, page_no int, seq long, post_id string, created_utc double, is_stickied boolean")
    assert {r.post_id: r.matched_keyword for r in D.walk_searches(df, None).collect()} == {"a": "z; y", "b": "z", "c": "y"}
    assert D.walk_searches(df, None, max_posts=2).count() == 2
    both = spark.createDataFrame([("a", "z; y", 0), ("a", "x", 1), ("b", "z; y", 0), ("c", "", 0), ("c", "q", 1)], "post_id string, matched_keyword string, source_no int")
    assert {r.post_id: r.matched_keyword for r in D.merge_sources(both).collect()} == {"a": "x; y; z", "b": "z; y", "c": "q"}


def test_links_of_live_listings(spark):
    schema = "href string, post_id string, card_title string, aria_label string, title_attr string, text string, author string, created string, comment_count string, stickied string, card_text string, community string, seq long"
    link = lambda seq, text, **more: (more.get("href", "/r/Test/comments/abc/x/"), "t3_abc", "", "", "", text, more.get("author", ""), more.get("created", ""), more.get("n", ""), "false", more.get("card", ""), "test", seq)
    df = spark.createDataFrame([link(0, "12 comments", n="12"), link(1, "Short"), link(2, "The longer title", author="u/ann", created="2026-07-31T12:00:00Z", n="9", card="Pinned by moderators"), link(3, "x", href="/r/other/comments/abc/"), link(4, "x", href="/about")], schema)
    (r,) = D.link_candidates(df).collect()
    assert (r.post_id, r.title, r.author, r.num_comments, r.is_stickied, r.subreddit) == ("abc", "The longer title", "ann", 12, True, "Test")
    parsed = spark.createDataFrame([("abc", "The", "", None, 20, "p"), ("q", "Q", "q", 1.0, 1, "p")], "post_id string, title string, author string, created_utc double, num_comments int, subreddit string")
    live = spark.createDataFrame([("abc", "The longer", "ann", 5.0, 12, "l"), ("n", "N", "n", 2.0, 3, "l")], parsed.schema)
    assert rows(D.merge_live(parsed, live)) == [("abc", "The longer", "ann", 5.0, 20, "p"), ("n", "N", "n", 2.0, 3, "l"), ("q", "Q", "q", 1.0, 1, "p")]


def test_manual_candidates_and_order(spark):
    df = spark.createDataFrame([("https://www.reddit.com/r/x/comments/AbC/slug/",), ("https://www.reddit.com/r/x/",)], "url string")
    got = {r.url: r for r in D.manual_candidates(df).collect()}
    assert [(r.post_id, r.subreddit, r.error) for r in got.values()][0] == ("AbC", "x", None) and got["https://www.reddit.com/r/x/"].error
    rows_ = spark.createDataFrame([(0, 5.0), (1, None), (2, 9.0), (3, 5.0), (4, 0.0)], "seq long, created_utc double")
    assert [r.seq for r in D.newest_first(rows_).orderBy("ordinal").collect()] == [2, 0, 3, 1, 4]
    assert [r[0] for r in df.limit(1).select(D.by_type(F.lit("odd"), True), D.by_type(F.lit("odd"), False)).first().asDict().items()] and df.limit(1).select(D.by_type(F.lit("odd"), True).alias("a"), D.by_type(F.lit("odd"), False).alias("b")).first() == (None, "full_scrape")


@pytest.mark.parametrize(("wanted", "n"), [("Test", 1), ("", 2)])
def test_communities(spark, wanted, n):
    assert spark.createDataFrame([("test",), ("other",)], "s string").filter(D.same_community("s", wanted)).count() == n
