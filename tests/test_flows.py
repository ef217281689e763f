import json
import os

import duckdb
import pandas as pd
import pytest
from test_sources import PAGES, landed, old_comment

import __spark_entry__
from colloquy.operators import classify, compare, exports, fetch
from colloquy.plans import pipelines, registry
from colloquy.streaming.ingest import ingest

DATA = "/root/testdata/sf0.001"
CANDIDATE = "post_id string, source string, seq long, title string, num_comments int, created_utc double"


def comments(spark, n=7):
    rows = [("t1" if k < 5 else "t0", k, f"c{k}", "Title", "Body " * 30, k % 3, f"parent {k}", f"root {k}", f"text {k}") for k in range(n)]
    return spark.createDataFrame(rows, "thread_id string, seq long, comment_id string, thread_title string, thread_body string, depth int, parent_body string, context_text string, body string")


def test_requests_never_mix_threads_and_render_context(spark):
    chunked = classify.chunk_by_thread(comments(spark), 2)
    assert {r.comment_id: (r.chunk, r.place) for r in chunked.collect()} == {"c0": (0, 0), "c1": (0, 1), "c2": (1, 0), "c3": (1, 1), "c4": (2, 0), "c5": (3, 0), "c6": (3, 1)}
    requests = {r.custom_id: r for r in classify.render_requests(chunked, 10).collect()}
    assert requests["chunk_1_t1"].user_content == "Thread: Title\nPost body: Body Body...\n\nComments:\n[c2] (depth 2)\n    Thread root: root 2\n    Replying to: parent 2\n    Comment: text 2\n[c3] (depth 0)\n    Comment: text 3"
    assert requests["chunk_0_t1"].comment_ids == ["c0", "c1"]
    with pytest.raises(ValueError):
        classify.chunk_by_thread(comments(spark), 0)


def test_answers_come_back_to_their_comments(spark):
    def model(content, ids):
        if "c5" in ids:
            raise RuntimeError("no answer")
        return [{"comment_id": i, "relevance_tag": "x", "icp_likelihood": "1"} for i in ids if i != "c1"], 1000, 10

    out = pipelines.classification_run(comments(spark), model, most=2)
    tags = {r.comment_id: r.relevance_tag for r in out["classified"].collect()}
    assert tags == {"c0": "x", "c1": "", "c2": "x", "c3": "x", "c4": "x", "c5": "", "c6": ""}
    assert tuple(out["usage"].first()) == (3000, 30, 1)
    assert classify.unclassified(out["classified"]).count() == 3
    assert classify.only_requested(comments(spark), out["requests"].filter("custom_id = 'chunk_0_t1'")).count() == 2
    assert out["usage"].select(classify.cost("input_tokens", "output_tokens", "smaller").alias("d"), classify.cost("input_tokens", "output_tokens", "none").alias("n")).first() == (0.0016, None)
    assert "tag" in classify.system_prompt("a tag")


def test_results_of_a_batch_as_rows(spark):
    def landed_result(i, kind, content):
        return (json.dumps({"custom_id": i, "result": {"type": kind, "message": {"usage": {"input_tokens": 10, "output_tokens": 2}, "content": content}}}),)

    answer = {"type": "tool_use", "input": {"classifications": [{"comment_id": "c", "relevance_tag": "x"}]}}
    rows = [landed_result("a", "succeeded", [{"type": "text"}, answer]), landed_result("b", "succeeded", [{"type": "text"}]), landed_result("c", "expired", []), ("{broken",)]
    results = classify.read_results(spark.createDataFrame(rows, "payload string"))
    assert {(r.custom_id, r.error) for r in classify.errors(results).collect()} == {("b", "no_tool_use_block"), ("c", "expired"), (None, "unreadable")}
    assert tuple(classify.usage(results).first()) == (20, 4, 3)  # tokens of an answer without a block were spent


def test_missing_labels_never_agree(spark):
    schema = "comment_id string, icp_likelihood string, relevance_tag string"
    a = spark.createDataFrame([("1", "1", "x"), ("2", "", "x"), ("3", "none", "y")], schema)
    b = spark.createDataFrame([("1", "1", "x"), ("2", "N/A", "x"), ("3", "none", "z"), ("4", "1", "x")], schema)
    out = pipelines.comparison_run(a, b, ("p", "q"))
    assert tuple(out["agreement"].first()) == (3, 2, 66.7, 2, 66.7)
    assert sorted(r.comment_id for r in out["disagreements"].collect()) == ["2", "3"]
    assert compare.agreement(compare.pair_up(a.limit(0), b, "comment_id", ["relevance_tag"], ("p", "q")), ["relevance_tag"], ("p", "q")).first()["relevance_tag_percent"] is None
    with pytest.raises(ValueError):
        compare.pair_up(a, b, "comment_id", [], ("p", "p"))


def test_an_incremental_run_twice_adds_nothing_the_second_time(spark):
    candidates = spark.createDataFrame([("t", "s", 0, "A title", 9, None), ("old", "s", 1, "A title", 9, 5.0), ("few", "s", 2, "A title", 0, None), ("u", "s", 3, "other", 9, None), ("t", "s", 4, "A title", 9, None)], CANDIDATE)
    options = pipelines.Options(days=1, min_comments=1, keywords=["TITLE"])
    none_p, none_c = spark.createDataFrame([], "post_id string"), spark.createDataFrame([("a",)], "comment_id string")
    out = pipelines.incremental_run(candidates, landed(spark, PAGES), none_p, none_c, 1e6, options)
    assert [r.post_id for r in out["posts"].collect()] == ["t"]
    assert {r.comment_id for r in out["comments"].collect()} == set("bcdefg")
    assert tuple(out["counts"].first()) == (6, 1)
    again = pipelines.incremental_run(candidates, landed(spark, PAGES), out["posts"].select("post_id"), none_c, 1e6, options)
    assert again["posts"].count() == again["comments"].count() == 0
    assert set(pipelines.incremental_run(candidates, landed(spark, PAGES), none_p, none_c, 1e6, pipelines.Options(dry_run=True))) == {"posts"}


def test_pages_of_a_thread_become_enriched_comments(spark):
    one = old_comment("c1", "one", 0, "t3_p1", old_comment("c2", "two", 1, "t1_c1"))
    two = old_comment("c2", "two again", 1, "t1_c1") + old_comment("c3", "three", 2, "t1_c2")
    pages = spark.createDataFrame([("p1", 0, one), ("p1", 1, two), ("p9", 0, one)], "post_id string, page_no int, html string")
    posts = spark.createDataFrame([("p1", "T", "B", "x", "manual", "", "/l/")], "post_id string, title string, body string, subreddit string, intake_mode string, matched_keyword string, permalink string")
    got = {r.comment_id: r for r in pipelines.thread_run(posts, pages, "now", pipelines.Options()).collect()}
    assert got.keys() == {"c1", "c2", "c3"} and got["c2"].body == "two again"
    assert (got["c3"].depth, got["c3"].ancestor_ids, got["c3"].context_text, got["c3"].thread_title) == (2, "c1>c2", "uc1: one\nuc2: two again", "T")


def test_a_repair_run_bypasses_discovery_and_refreshes(spark):
    """Failures of a run are the targets of the next; its comments come back whether they are known or not."""
    failed = exports.failures(spark.createDataFrame([("T", "x", "https://www.reddit.com/r/x/comments/T/s/", 2, "timeout"), ("ok", "y", "", 1, None), ("u", "z", None, 1, "blocked")], "post_id string, title string, permalink string, attempt int, error string"), "now")
    assert failed.columns == ["post_id", "title", "permalink", "attempt", "error", "failed_at"] and failed.count() == 2
    lines = [r.line for r in exports.failed_targets(failed).orderBy("line").collect()]
    assert lines == ["https://www.reddit.com/r/x/comments/T/s/", "u"]
    targets = spark.createDataFrame(list(enumerate(["# again", *lines, "bad line!"], 1)), "seq long, line string")
    state_posts = spark.createDataFrame([("t3_t", "/kept/", "x", "Stored", "full_scrape", "", 9, "2024")], "post_id string, permalink string, subreddit string, title string, source_type string, matched_keyword string, reported_comment_count int, last_scraped_at string")
    known = spark.createDataFrame([("a",), ("b",)], "comment_id string")
    out = pipelines.repair_run(targets, state_posts, landed(spark, PAGES), known, pipelines.Options())
    posts = {r.post_id: r for r in out["posts"].collect()}
    assert posts["t3_t"].title == "Stored" and posts["t3_t"].permalink.endswith("/T/s/") and posts["u"].intake_mode == "repair"
    assert {(r.comment_id, r.is_new) for r in out["comments"].collect()} == {(c, c not in "ab") for c in "abcdefg"}
    assert [(r.seq, r.error) for r in out["errors"].collect()] == [(4, "line 4: no post id in bad line!")] and tuple(out["counts"].first()) == (5, 2)


def test_pages_that_continue_a_thread(spark):
    link = lambda n: f'<a href="/r/x/comments/p1/t/{n}/?context=3">continue this thread</a>'
    url = lambda n: f"https://old.reddit.com/r/x/comments/p1/t/{n}/?context=3&limit=500&sort=confidence&show=all"
    rows = [("p1", None, old_comment("c1", "one", 0) + link("a") + link("b")), ("p1", url("a"), old_comment("c2", "two", 0) + link("c")), ("p1", url("b"), old_comment("c1", "one again", 0) + link("a")), ("p1", url("c"), old_comment("c3", "three", 0)), ("p2", None, old_comment("c9", "x", 0))]
    pages, posts = spark.createDataFrame(rows, "post_id string, url string, html string"), spark.createDataFrame([("p1", "T", "", "x", "m", "", "/l/"), ("p3", "", "", "", "", "", "")], "post_id string, title string, body string, subreddit string, intake_mode string, matched_keyword string, permalink string")
    walked = pipelines.thread_pages(posts, pages)
    assert [(r.page_no, "c3" in r.html) for r in walked.orderBy("page_no").collect()] == [(0, False), (1, False), (2, False), (3, True)]
    assert pipelines.thread_pages(posts, pages, max_continue=2).count() == 3
    found = pipelines.thread_run(posts, walked, "now", pipelines.Options())
    assert {r.comment_id: r.body for r in found.collect()} == {"c1": "one again", "c2": "two", "c3": "three"}
    assert {r.post_id: r.fetched_comment_count for r in pipelines.fetched_counts(posts, found).collect()} == {"p1": 3, "p3": 0}
    capped = pipelines.thread_run(posts, walked, "now", pipelines.Options(max_comments=2))
    assert {r.comment_id: r.body for r in capped.collect()} == {"c1": "one", "c2": "two"}  # the walk ends at the second comment


def test_masters_snapshots_and_checkpoints(spark, tmp_path):
    folder = f"file://{tmp_path}/m"
    posts = lambda *rows: spark.createDataFrame(rows, "post_id string, title string, author string, odd int")
    none = spark.createDataFrame([], "comment_id string, body string")
    assert exports.write_master(folder, "1", none, posts(("a", "A", "x", 1), ("b", "B", "x", 1))) == (False, True)
    assert exports.write_master(folder, "2", spark.createDataFrame([("c1", "one")], "comment_id string, body string"), posts(("b", "B2", None, 1), (" ", "no", "x", 1), ("c", "C", "y", 1))) == (True, True)
    got = [(r.post_id, r.title, r.author) for r in exports.read_export(spark, f"{folder}/posts").orderBy("place").collect()]
    assert got == [("a", "A", "x"), ("b", "B2", ""), ("c", "C", "y")]
    master = posts(("a", "A", "x", 1))
    incoming = spark.createDataFrame([("a", 0), ("b", 1), ("b", 2), ("", 3), (None, 4)], "post_id string, seq long")
    assert [exports.checkpoint(master, incoming, "post_id", "seq", u)[1].first()[0] for u in (False, True)] == [1, 5]
    exports.write_snapshot(f"{folder}/s", "r1", none, posts(("a", "A", "x", 1)))
    assert (tmp_path / "m/s/run_id=r1/posts").exists() and not (tmp_path / "m/s/run_id=r1/comments").exists()


def test_union_over_sort_passes(spark):
    passes = spark.createDataFrame([("p", 1, True, None, 9), ("p", 2, False, None, 9), ("p", 3, True, None, 9), ("p", 4, True, None, 9), ("p", 5, True, None, 9), ("q", 1, True, False, 9), ("q", 2, True, None, 9)], "post_id string, pass_no int, has_data boolean, meta_truncated boolean, expected int")
    rows = spark.createDataFrame([("p", 1, 0, "a"), ("p", 1, 1, "b"), ("p", 3, 0, "b"), ("p", 3, 1, "c"), ("p", 4, 0, "a"), ("p", 5, 0, "z"), ("q", 1, 0, "a"), ("q", 2, 0, "b")], "post_id string, pass_no int, seq int, comment_id string")
    kept, facts = fetch.union_passes(passes, rows)
    assert sorted((r.post_id, r.comment_id) for r in kept.collect()) == [("p", "a"), ("p", "b"), ("p", "c"), ("q", "a")]  # pass 4 adds nothing
    assert {r.post_id: (r.calls, r.collected, r.truncated) for r in facts.collect()} == {"p": (4, 3, True), "q": (1, 1, False)}
    kept, facts = fetch.union_passes(passes, rows, max_comments=2)
    assert kept.count() == 3 and {r.post_id: r.calls for r in facts.collect()} == {"p": 1, "q": 1}


def test_a_new_checkpoint_on_an_old_table_loses_nothing(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    landing.mkdir()
    schema = spark.createDataFrame([], "post_id string, created_utc double").schema
    for n, ids in enumerate((["a", "b"], ["b", "c"])):
        (landing / f"{n}.json").write_text("\n".join(json.dumps({"post_id": i, "created_utc": 1.0}) for i in ids))
        ingest(spark, str(landing), schema, out, str(tmp_path / f"mark{n}")).awaitTermination()
    assert sorted(r.post_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_streaming_ingest_is_idempotent(spark, tmp_path):
    landing, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    landing.mkdir()
    (landing / "1.json").write_text("\n".join(json.dumps({"post_id": i, "created_utc": float(k)}) for k, i in enumerate(["a", "b", "a", ""])))
    schema = spark.createDataFrame([], "post_id string, created_utc double").schema
    ingest(spark, str(landing), schema, out, mark).awaitTermination()
    (landing / "2.json").write_text("\n".join(json.dumps({"post_id": i, "created_utc": 9.0}) for i in ("b", "c")))
    for _ in range(2):
        ingest(spark, str(landing), schema, out, mark).awaitTermination()
    assert sorted((r.post_id, r.created_utc) for r in spark.read.parquet(out).collect()) == [("a", 0.0), ("b", 1.0), ("c", 9.0)]


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def _rows(frame):
    def cell(v):
        if v is None or v is pd.NA or v != v:
            return None
        return str(int(v)) if isinstance(v, float) and v.is_integer() else round(v, 6) if isinstance(v, float) else str(v)

    return sorted(([cell(v) for v in r] for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_queries_against_sql(spark, db, name):
    got = registry.QUERIES[name](spark, DATA).toPandas()
    if sql := registry.ORACLES.get(name):
        want = db.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert _rows(got) == _rows(want)
    else:
        assert len(got)


def test_entry_points(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


def test_discovery_export_keeps_counts_of_zero_that_come_as_text(spark, tmp_path):
    """The query against its SQL on documents without characters, without a size and without a source."""
    docs = [(5, "", "en", "s1", 0), (6, "ab", "en", None, 2), (7, None, "en", "s2", None)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = __spark_entry__.queries()["discovery_export"](spark, str(tmp_path))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        wanted = con.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()['discovery_export']}) ORDER BY post_id").fetchall()
    assert [tuple(r) for r in got.orderBy("post_id").collect()] == wanted
    assert wanted[0][6] == "0"
    numbers = spark.createDataFrame([("a", "s", "t", "k", "x", 0, 0, 0.0, "/p"), ("b", "s", "t", None, "x", 3, 4, 1.0, None)], "post_id string, subreddit string, source_type string, matched_keyword string, title string, score int, num_comments int, created_utc double, permalink string")
    assert [(r.matched_keyword, r.score, r.num_comments, r.created_utc, r.permalink) for r in exports.discovered(numbers).orderBy("post_id").collect()] == [("k", "", "", "", "https://www.reddit.com/p"), ("", "3", "4", "1.0", "")]
