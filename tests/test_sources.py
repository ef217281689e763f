import json

import duckdb
import pytest

from colloquy.plans import registry
from colloquy.sources import files, html, jsontree


def old_comment(i, body, depth=None, parent=None, inner="", entry=True):
    attributes = f'data-fullname="t1_{i}"' + (f' data-depth="{depth}"' if depth is not None else "") + (f' data-parent-fullname="{parent}"' if parent else "")
    own = f'<div class="entry"><a class="author">u{i}</a><span class="score" title="{len(i)} points"></span><time datetime="2026-01-02T03:04:05+00:00"></time><div class="usertext-body"><div class="md"><p>{body}</p></div></div><a class="bylink" href="/r/x/comments/p1/t/{i}/">link</a></div>'
    return f'<div class="thing comment" {attributes}>{own if entry else ""}<div class="child">{inner}</div></div>'


def parents(page, post="p1", **options):
    return {r["comment_id"]: r["parent_id"] for r in html.parse_thread(page, post, **options)[0]}


def test_old_listing_with_promotion_and_next_page():
    page = (
        '<div class="thing link" data-fullname="t3_post1" data-author="ann" data-score="15" data-comments-count="12" data-permalink="/r/test/comments/post1/x/"><a class="title">The  title</a><time datetime="2026-07-31T12:00:00Z"></time></div>'
        '<div class="thing link promotedlink" data-fullname="t3_ad"></div><div class="thing link" data-fullname="t5_no"></div><span class="next-button"><a href="/r/test/new/?after=t3_post1">next</a></span>'
    )
    rows, following = html.parse_listing(page, "test")
    assert [(r["post_id"], r["title"], r["num_comments"], r["score"], r["author"], r["subreddit"], r["created_utc"]) for r in rows] == [("post1", "The title", 12, 15, "ann", "test", 1785499200.0)]
    assert following == "https://old.reddit.com/r/test/new/?after=t3_post1"


def test_modern_listing():
    page = (
        '<shreddit-post id="t3_m1" post-title="Modern" comment-count="1,017" score="3" author="a" permalink="/r/test/comments/m1/x/" subreddit-prefixed-name="r/Test" created-timestamp="2026-07-31T12:00:00.000Z" is-stickied></shreddit-post>'
        '<shreddit-post permalink="/r/test/comments/m2/y/"><h2>From <b>head</b></h2></shreddit-post><shreddit-post id="t3_m1"></shreddit-post><shreddit-post id="t3_ad" promoted="true"></shreddit-post>'
    )
    rows, following = html.parse_listing(page, "fallback")
    assert [(r["post_id"], r["title"], r["num_comments"], r["subreddit"]) for r in rows] == [("m1", "Modern", 1017, "Test"), ("m2", "From head", 0, "fallback")]
    assert following is None


def test_bare_links_keep_the_longest_title_of_the_community():
    page = '<a href="/r/test/comments/abc/s/">A post</a><a href="/r/TEST/comments/abc/s/">A longer post</a><a href="/r/test/comments/abc/s/">14 comments</a><a href="/r/other/comments/zzz/s/">Other</a><a href="/about">x</a>'
    rows, _ = html.parse_listing(page, "test")
    assert [(r["post_id"], r["title"]) for r in rows] == [("abc", "A longer post")]


def test_old_thread_by_attribute_nesting_and_depth():
    nested = old_comment("c1", "one", 0, "t3_p1", old_comment("c2", "two", 1, "t1_c1", old_comment("c3", "three", 2, "t1_c2")))
    rows, more = html.parse_thread(nested + '<a href="/r/x/comments/p1/t/c3/?context=3">Continue  this thread</a>', "p1")
    assert [(r["comment_id"], r["parent_id"], r["depth"], r["body"], r["author"], r["score"]) for r in rows] == [("c1", "p1", 0, "one", "uc1", 2), ("c2", "c1", 1, "two", "uc2", 2), ("c3", "c2", 2, "three", "uc3", 2)]
    assert more == ["https://old.reddit.com/r/x/comments/p1/t/c3/?context=3"]
    assert parents(old_comment("c1", "a", inner=old_comment("c2", "b", inner=old_comment("c3", "c")))) == {"c1": "p1", "c2": "c1", "c3": "c2"}
    assert parents("".join(old_comment(f"c{k + 1}", "x", d) for k, d in enumerate((0, 1, 2, 0)))) == {"c1": "p1", "c2": "c1", "c3": "c2", "c4": "p1"}


def test_a_deleted_parent_of_a_flat_page_is_gone_before_parents_are_inferred():
    page = old_comment("c1", "x", 0) + old_comment("c2", "[deleted]", 0) + old_comment("c3", "y", 1)
    assert parents(page) == {"c1": "p1", "c3": "c1"}
    assert parents(page, include_deleted=True) == {"c1": "p1", "c2": "p1", "c3": "c2"}
    assert parents(old_comment("c1", "x", 2)) == {"c1": ""} and parents(old_comment("c1", "x", entry=False)) == {}


def test_modern_thread():
    page = (
        '<shreddit-post id="t3_m" post-title="T" score="2"><div slot="text-body"><p>Post body</p></div></shreddit-post>'
        '<shreddit-comment thingid="t1_a" parentid="t3_m" depth="0" author="x" score="8"><div slot="comment"><p>Root</p></div>'
        '<shreddit-comment thingid="t1_b" depth="1"><div slot="comment">Reply</div></shreddit-comment></shreddit-comment><shreddit-comment thingid="t1_a"></shreddit-comment>'
    )
    rows, _ = html.parse_thread(page, "m")
    assert [(r["comment_id"], r["parent_id"], r["author"]) for r in rows] == [("a", "m", "x"), ("b", "a", "[deleted]")]
    post = html.parse_post(page, {"post_id": "m", "title": "old", "author": "known", "num_comments": 7})
    assert (post["title"], post["body"], post["author"], post["score"], post["num_comments"]) == ("T", "Post body", "known", 2, 7)
    assert html.parse_post("<p>nothing</p>", {"post_id": "q"}) == {"post_id": "q"}


def test_links_that_are_controls_are_no_titles():
    page = "".join(f'<a href="/r/test/comments/abc/s/">{t}</a>' for t in ("Open post", "12 replies", "Real title", "more options and so on", "3 shares"))
    assert [r["title"] for r in html.parse_listing(page.replace("more options and so on", "more options"), "test")[0]] == ["Real title"]
    assert html.parse_listing('<a href="/r/test/comments/abc/s/">report</a>', "test")[0][0]["title"] == "report"


BIG = (1 << 60) + 1


def test_ids_and_other_columns_pass_untouched(spark):
    """Large ids beside a null, timestamps and arrays: none is read as a float or changed."""
    pages = spark.sql(f"SELECT * FROM VALUES (CAST({BIG} AS BIGINT), '<title>a</title>', array(1L, NULL)), (NULL, '<title>b</title>', NULL) AS t(page_id, html, more)")
    assert {(r.page_id, r.title, tuple(r.more or ())) for r in html.page_facts(pages, ["page_id", "more"]).collect()} == {(BIG, "a", (1, None)), (None, "b", ())}
    landed_ = spark.sql(f"""SELECT * FROM VALUES (CAST({BIG} AS BIGINT), '{{"comments": [{{"id": {BIG}}}], "page": {{"hasMore": true, "nextCursor": 7}}}}'), (NULL, NULL) AS t(k, payload)""")
    assert [(r.k, r.comment_id) for r in jsontree.flatten(landed_, ["k"]).collect()] == [(BIG, str(BIG))]
    assert [(r.k, r.next_cursor) for r in jsontree.cursors(landed_, ["k"]).collect()] == [(BIG, "7")]


def test_pages_that_are_no_objects_give_no_rows_and_are_named(spark):
    payloads = ["[]", '"x"', "{broken", "", None, "3", '{"comments": 5, "page": []}', '{"comments": [7, null, {"id": "a"}]}']
    pages = spark.createDataFrame([(f"t{n}", None, p) for n, p in enumerate(payloads)], "thread_id string, cursor string, payload string")
    assert [r.comment_id for r in jsontree.flatten(pages, ["thread_id"]).collect() if r.comment_id] == ["a"]
    assert jsontree.cursors(pages, ["thread_id"]).collect() == []
    assert {r.thread_id: r.error for r in jsontree.faults(pages).collect()} == {"t0": "not an object", "t1": "not an object", "t2": "invalid JSON", "t5": "not an object"}
    mixed = spark.createDataFrame([("t", None, json.dumps({"comments": [item("a", [], "bad")]})), ("t", "bad", "[1"), ("u", None, json.dumps({"comments": [item("b")]}))], "thread_id string, cursor string, payload string")
    assert {(r.thread_id, r.comment_id, r.truncated) for r in jsontree.assemble(mixed).collect()} == {("t", "a", True), ("u", "b", False)}


def test_malformed_pages(spark):
    pages = spark.createDataFrame([(1, "<p>a<p>b</i><script>x='</p>'</script><title>T</title><h1>H"), (2, None), (3, "")], "page_id long, html string")
    got = {r.page_id: (r.title, r.h1, r.links) for r in html.page_facts(pages, ["page_id"]).collect()}
    assert got == {1: ("T", "H", 0), 2: ("", "", 0), 3: ("", "", 0)}
    deep = "<div>" * 5000 + "x"
    assert html.parse(deep).text() == "x"


def test_references_that_are_cut_off_stay_text(spark):
    """Titles cut to a length before or after any character of a reference, against the query's SQL."""
    cuts = ["a &amp", "&am", "&a", "&", "&quot", "x &quo y", "&copy 1", "&amp;amp", "&amp;lt;", "&amp;&lt;b&gt; &quot;q&quot; &copy; &middot;", "&amp;&amp", "&ampx;", "&&amp;&"]
    pages = spark.createDataFrame([(n, f'<title>{c}</title><h1>{c}</h1><a href="/?a=1&copy=2">x</a>') for n, c in enumerate(cuts)], "page_id long, html string")
    got = [tuple(r) for r in html.page_facts(pages, ["page_id"]).orderBy("page_id").collect()]
    with duckdb.connect() as con:
        con.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
        con.executemany("INSERT INTO pages VALUES (?, ?)", [tuple(r) for r in pages.collect()])
        assert got == con.execute(f"SELECT page_id, title, h1, links FROM ({registry.ORACLES['parse_pages']}) ORDER BY 1").fetchall()
    assert [r[1] for r in got][:4] == ["a &amp", "&am", "&a", "&"]
    assert html.page_facts(spark.createDataFrame([(1, "<title>&#39;&#x41;&eacute; &#4</title>")], "page_id long, html string"), ["page_id"]).first().title == "'Aé &#4"


def item(i, replies=None, more=None):
    out = {"id": i, "text": f"body {i}"}
    if replies is not None or more:
        out["replies"] = {"items": replies or [], "page": {"hasMore": bool(more), "nextCursor": more}}
    return out


def landed(spark, pages, thread="t"):
    return spark.createDataFrame([(thread, c, json.dumps(p)) for c, p in pages.items()], "thread_id string, cursor string, payload string")


PAGES = {
    None: {"post": {"id": "p"}, "comments": [item("a", [item("b", [item("c", more="deep")], more="wide")])], "page": {"hasMore": True, "nextCursor": "next"}},
    "deep": {"comments": [item("e")]},
    "wide": {"comments": [item("d"), item("b", [item("f")])]},
    "next": {"comments": [item("g")], "page": {"hasMore": False, "nextCursor": "no"}},
}


def queue_model(pages):
    queue, seen, found = [(None, 0)], {(None, 0)}, {}

    def walk(x, depth):
        found.setdefault(x["id"], depth)
        for r in x.get("replies", {}).get("items", []):
            walk(r, depth + 1)
        follow(x.get("replies", {}).get("page"), depth + 1)

    def follow(page, depth):
        if page and page.get("hasMore") and page.get("nextCursor") and (page["nextCursor"], depth) not in seen:
            seen.add((page["nextCursor"], depth))
            queue.append((page["nextCursor"], depth))

    while queue:
        cursor, depth = queue.pop(0)
        if page := pages.get(cursor):
            for x in page["comments"]:
                walk(x, depth)
            follow(page.get("page"), depth)
    return list(found.items())


def test_trees_over_cursors(spark):
    got = jsontree.assemble(landed(spark, PAGES)).orderBy("visit").collect()
    assert [(r.comment_id, r.depth) for r in got] == queue_model(PAGES)
    assert not any(r.truncated for r in got)
    capped = jsontree.assemble(landed(spark, PAGES), max_comments=3).orderBy("visit").collect()
    assert [r.comment_id for r in capped] == [i for i, _ in queue_model(PAGES)][:3] and all(r.truncated for r in capped)
    assert {r.comment_id for r in jsontree.assemble(landed(spark, PAGES), max_pages=1).collect()} == {"a", "b", "c"}
    gone = {k: v for k, v in PAGES.items() if k != "wide"}
    assert all(r.truncated for r in jsontree.assemble(landed(spark, gone)).collect())


def test_cursors_in_a_circle_end(spark):
    pages = {None: {"comments": [item("a", [], "again")]}, "again": {"comments": [item("b", [], "again")]}}
    got = jsontree.assemble(landed(spark, pages)).orderBy("visit").collect()
    assert [(r.comment_id, r.depth) for r in got] == [("a", 0), ("b", 1)] and all(r.truncated for r in got)


def test_csv(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_bytes('﻿id,body,empty\n1,"two\nlines, ""quoted""",\n2,"",x\n'.encode())
    df = files.read_csv(spark, str(path))
    assert [tuple(r) for r in df.collect()] == [("1", 'two\nlines, "quoted"', ""), ("2", "", "x")]
    (tmp_path / "y.csv").write_bytes("id,body\n1,café “q”\n".encode("windows-1252"))
    assert files.read_csv(spark, str(tmp_path / "y.csv")).first()["body"] == "café “q”"
    assert sorted(r.id for r in files.key_set(spark, str(path), "id").collect()) == ["1", "2"]
    assert files.write_csv(df, str(tmp_path / "out"), ["id", "body", "more"], exact=False)
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "out")).orderBy("id").collect()][0] == ("1", 'two\nlines, "quoted"', "")
    assert not files.write_csv(df.limit(0), str(tmp_path / "none"), ["id", "body", "empty"]) and not (tmp_path / "none").exists()
    with pytest.raises(ValueError, match="empty"):
        files.write_csv(df, str(tmp_path / "z"), ["id", "body"])


def test_encodings_are_found_in_whole_files(spark, tmp_path):
    text = "El niño comió crème brûlée – “así” – en Málaga, ¿verdad? Übergröße für Señor Núñez."
    for encoding in ("utf-8", "cp1252", "mac_roman", "utf-16"):
        assert files.detect_encoding(text.encode(encoding)) == encoding
    assert files.detect_encoding("café".encode("cp1252")) == "cp1252" and files.detect_encoding("café".encode("mac_roman")) == "mac_roman" and files.detect_encoding(b"") == "utf-8"
    folder = tmp_path / "many"
    folder.mkdir()
    plain = "plain words " * 110_000  # the first byte that tells is beyond a megabyte
    (folder / "a.csv").write_bytes(f"id,body\n1,{plain}\n2,café\n".encode("cp1252"))
    (folder / "b.csv").write_bytes("id,body\n3,niño\n".encode())
    (folder / "c.csv").write_bytes("id,body\n4,crème “x”\n".encode("mac_roman"))
    got = {r.id: r.body for r in files.read_csv(spark, str(folder)).collect()}
    assert got == {"1": plain, "2": "café", "3": "niño", "4": "crème “x”"}


def test_labels_of_paths():
    assert files.label_from_path("/x/comments_classified_larger.csv") == "larger" and files.label_from_path("plain.csv") == "plain"


def test_repair_lists(spark):
    lines = ["# a note", "", "abc", "https://x.example/r/t/comments/Def/slug/", " t3_abc ", "t1_zz"]
    got = files.parse_repair_list(lines)
    assert [t["post_id"] for t in got] == ["abc", "def", "zz"]
    assert [t["post_id"] for t in files.parse_repair_list(["t3_AbC"], keep_case=True)] == ["AbC"]
    with pytest.raises(ValueError, match="line 1.*line 3"):
        files.parse_repair_list(["no id!", "ok", "https://x.example/none"])
    with pytest.raises(ValueError, match="line 1"):
        files.parse_repair_list(["/r/t/comments/def/"])
    with pytest.raises(ValueError):
        files.parse_repair_list(["#"])
    known = spark.createDataFrame([("t3_abc", "/kept/", "c", "t", "full_scrape", "k")], "post_id string, permalink string, subreddit string, title string, source_type string, matched_keyword string")
    rows = files.resolve_repairs(spark, got, known).orderBy("seq").collect()
    assert [(r.permalink, r.title) for r in rows] == [("/kept/", "t"), ("https://x.example/r/t/comments/Def/slug/", ""), ("https://www.reddit.com/comments/zz/", "")]
    twice = spark.createDataFrame([("abc", "/old/", "2024"), ("abc", "/new/", "2025")], "post_id string, permalink string, last_scraped_at string")
    assert files.resolve_repairs(spark, got[:1], twice).first()["permalink"] == "/new/"


def test_small_files_in_any_store(spark, tmp_path):
    uri = f"file://{tmp_path}/ledger.json"
    assert files.read_ledger(uri) == {}
    files.update_ledger(uri, "b", status="sent")
    assert files.update_ledger(uri, "b", done=1) == files.read_ledger(str(tmp_path / "ledger.json")) == {"b": {"status": "sent", "done": 1}}
    with pytest.raises(FileNotFoundError):
        files.load_config(f"file://{tmp_path}/none.json", {})


def test_names_and_rubrics():
    assert files.stamped_name("comments", "1", set()) == "comments_1" and files.stamped_name("comments", "1", {"comments_1", "comments_1_2"}) == "comments_1_3"
    assert files.classified_path("/x/y.csv", "small") == "/x/y_classified_small.csv" and files.classified_path("y.csv", "a") == "./y_classified_a.csv"
    table = "| Who | Question | Tag |\n|---|---|---|\n| All | what? | `own-words` |\n| 2A | why? | see below |\n| 3 | how? | `plan` |\n"
    assert files.rubric_tags(table) == [("All", "own-words"), ("3", "plan"), ("All", "none")]


def test_driver_side_helpers(tmp_path):
    assert files.parse_selection("1, 5-3,9,x,4", 6) == ([1, 3, 4, 5], ["x"]) and files.parse_selection("ALL", 3) == ([1, 2, 3], [])
    sources = [{"name": "One"}, {"name": "two"}]
    assert files.select_sources(sources, "ONE") == [{"name": "One"}] and files.select_sources(sources, "x", strict=False) == []
    with pytest.raises(ValueError):
        files.select_sources(sources, "x")
    (tmp_path / "c.json").write_text('{"days": -3, "flag": "yes", "other": 1}')
    assert files.load_config(str(tmp_path / "c.json"), {"days": 7, "flag": False, "kept": "x"}) == {"days": 0, "flag": True, "kept": "x", "other": 1}
    assert files.read_ledger(str(tmp_path / "l.json")) == {}
    files.update_ledger(str(tmp_path / "l.json"), "b", status="sent")
    assert files.update_ledger(str(tmp_path / "l.json"), "b", done=1) == {"b": {"status": "sent", "done": 1}}
