import pytest
from pyspark.sql import functions as F

from colloquy.functions import text as X
from colloquy.functions import urls as U


def one(spark, expression, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression.alias("y")).first()["y"]


@pytest.mark.parametrize(("given", "want"), [(" a\n\tb\xa0 c\x1c", "a b c"), (None, ""), ("", ""), ("\x85x", "x")])
def test_clean_text(spark, given, want):
    assert one(spark, X.clean_text("x"), given) == want
    assert " ".join((given or "").split()) == want


@pytest.mark.parametrize(("given", "want"), [("1,234 comments", 1234), ("-5", -5), ("1.2k", 1), (",", 9), ("none", 9), (None, 9), ("99999999999999999999", 9)])
def test_parse_int(spark, given, want):
    assert one(spark, X.parse_int("x", 9), given) == want


@pytest.mark.parametrize(
    ("given", "want"), [("1700000000", 1.7e9), ("1700000000.5", 1700000000.5), ("2026-07-31T12:00:00Z", 1785499200.0), ("2026-07-31T12:00:00+00:00", 1785499200.0), ("2026-07-31T12:00:00.250Z", 1785499200.25), ("soon", None), (None, None)]
)
def test_parse_created(spark, given, want):
    assert one(spark, X.parse_created("x"), given) == want


def test_to_iso(spark):
    assert one(spark, X.to_iso("x"), 1785499200.0, "double") == "2026-07-31T12:00:00+00:00"
    assert one(spark, X.to_iso("x"), 1785499200.25, "double") == "2026-07-31T12:00:00.250000+00:00"
    assert one(spark, X.to_iso("x"), None, "double") == ""
    assert one(spark, X.to_iso("x"), 0.0, "double") == "1970-01-01T00:00:00+00:00"
    assert one(spark, X.to_iso("x", zero_is_missing=True), 0.0, "double") == ""


def test_ids(spark):
    assert one(spark, X.strip_fullname("x"), "t3_abc") == "abc" and one(spark, X.strip_fullname("x"), "t5_abc") == "t5_abc"
    assert one(spark, X.normalize_post_id("x"), " t3_AbC ") == "abc"
    assert one(spark, X.to_fullname("x"), "abc") == "t3_abc" and one(spark, X.to_fullname("x"), "t1_abc") == "t1_abc"
    assert one(spark, X.after_cursor("x"), "abc") == "dDNfYWJj"


@pytest.mark.parametrize(("given", "limit", "want"), [("  abcdef ", 4, "abcd..."), ("abc  def", 5, "abc..."), ("abc", 4, "abc"), ("abcdef", 0, "abcdef"), (None, 3, ""), ("é你\U0001f600x", 3, "é你\U0001f600...")])
def test_truncate(spark, given, limit, want):
    assert one(spark, X.truncate("x", limit), given) == want


def test_normalize_for_match(spark):
    assert one(spark, X.normalize_for_match("x"), "Café ﬁN²") == "cafe fin2"
    assert one(spark, X.normalize_for_match("x"), None) == ""


def test_first_present_keeps_zero_false_and_empty(spark):
    pick = X.first_present("x", "a.b", "c")
    for given, want in (('{"a":{"b":0},"c":1}', "0"), ('{"a":{"b":null},"c":1}', "1"), ('{"a":5,"c":""}', ""), ('{"a":{"b":false}}', "false"), ("{}", None)):
        assert one(spark, pick, given) == want


def test_gone_and_outcomes(spark):
    for given, want in (("[Deleted]", True), (" [removed] ", True), ("", True), (None, True), ("deleted", False)):
        assert one(spark, X.is_gone("x"), given) is want
    for status, want in ((200, "ok"), (429, "retry"), (503, "retry"), (403, "failed")):
        assert one(spark, X.fetch_outcome("x", F.lit("")), status, "int") == want


def test_urls(spark):
    path = "/r/test/comments/post1/example/"
    assert one(spark, U.old_url("x"), path) == "https://old.reddit.com" + path
    assert one(spark, U.modern_url("x"), "https://old.reddit.com" + path) == "https://www.reddit.com" + path
    assert one(spark, U.modern_url("x"), "https://other.example/a") == "https://other.example/a"
    assert one(spark, U.absolute("x"), " ") is None
    assert one(spark, U.post_id("x"), path) == "post1" and one(spark, U.community("x"), path) == "test" and one(spark, U.post_id("x"), "/r/test/") == ""
    assert one(spark, U.is_post_path("x"), path) is True and one(spark, U.is_post_path("x"), "/r/test/") is False
    assert len(one(spark, U.variants("x"), path)) == 2


def test_url_building():
    assert U.with_query("https://a.example/x?a=1&b=2&a=3", b=None, c="d e") == "https://a.example/x?a=3&c=d+e"
    assert U.listing_url("x", "odd") == "https://old.reddit.com/r/x/new/?limit=100" and U.listing_url("x y", "top", "week") == "https://old.reddit.com/r/x+y/top/?limit=100&t=week"
    assert U.search_url("x", "ä b", "odd") == "https://old.reddit.com/r/x/search?q=%C3%A4+b&restrict_sr=on&sort=new&t=all&limit=100"
    assert U.thread_url("https://a.example/t/?context=3") == "https://a.example/t/?context=3&limit=500&sort=confidence&show=all"


def test_post_paths_and_repair_targets(spark):
    for path, want in (("/r/a/comments/x1/", True), ("/r/a/comments/-x", False), ("/R/a/Comments/x", True)):
        assert one(spark, U.is_post_path("x"), path) is want
    for line, want in ((" t3_AbC ", "abc"), ("t1_x", "x"), ("https://x.example/r/t/Comments/Def/slug/", "def"), ("/r/t/comments/def/", None), ("no id!", None), ("https://x.example/none", None), ("", None), (None, None)):
        assert one(spark, U.repair_target("x"), line) == want
    assert one(spark, U.repair_target("x", True), "t3_AbC") == "AbC" and one(spark, U.repair_target("x", True), "t1_x") is None


def test_titles_are_no_counters_or_controls(spark):
    for text, want in (("12 replies", False), ("3 shares", False), ("votes", False), ("1.2 comments", False), ("Open Post", False), ("more options", False), ("report", True), ("12 points", True), ("1.2k votes", True), ("A title", True)):
        assert one(spark, X.is_title("x"), text) is want and X.is_title_text(text) is want
