import base64
import gzip
import hashlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from colloquy.llm import warc as W


@given(st.lists(st.lists(st.integers(0, 30), max_size=9), max_size=17))
def test_loser_tree_merges(runs):
    runs = [sorted(r) for r in runs]
    assert list(W.LoserTree(runs)) == sorted(sum(runs, []))


@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=9), max_size=17))
def test_blocks_join_a_merge_when_their_turn_comes(blocks):
    blocks = sorted(sorted(b) for b in blocks)
    assert list(W.merged(iter(blocks))) == sorted(sum(blocks, []))


def rows():
    page = [
        (1, "https://www.b.example/x", "<p>same</p>"), (2, "http://a.example/?q=1", "<p>same</p>"), (3, "http://a.example/", "other é 你"), (4, None, None), (5, "http://a.example/", ""), (6, "not a url\n", "x" * 70000),
        (7, "http://a.example/", "<p>same</p>"), (7, "http://a.example/", "<p>same</p>"), (None, "http://c.example:8080/A#f", "<p>same</p>"), (None, None, "alone"), (8, "http://[bad", "\r\n\r\n"),
    ]
    return page + [(100 + k, f"http://h{k % 3}.example/{k % 5}", "hot") for k in range(40)]


def expected(pages, least=0):
    groups = defaultdict(list)
    for i, _, h in pages:
        groups[h or ""].append(i)
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        last = max((x for x in groups[h or ""] if x is not None), default=None)
        revisit = len(groups[h or ""]) > 1 and len(data) >= least and i != last
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def frame(spark):
    return spark.createDataFrame(rows(), "page_id long, url string, html string").repartition(4)


def test_archives_and_global_order(spark):
    for options in ({}, {"run_entries": 3, "least_bytes": 5}, {"run_entries": 5, "block_entries": 2, "ranges": 7}):
        got = W.archive_pages(frame(spark), **options).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows(), options.get("least_bytes", 0))
        order = sorted(got, key=lambda r: r.position)
        assert [r.position for r in order] == list(range(len(got)))
        keys = [(r.url_key, r.captured, W.NO_ID if r.page_id is None else r.page_id) for r in order]
        assert keys == sorted(keys)


def test_files_are_whole_gzip_members(spark, tmp_path):
    index = W.write_archives(frame(spark), folder=f"file://{tmp_path}/w")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").iterdir()))
    assert data.count(b"WARC/1.1\r\n") == len(rows()) == index.count()


def test_a_task_that_runs_twice_leaves_one_archive(spark, tmp_path):
    """The second attempt sees its rows in another order; only the committed names are read, and the rest is removed."""
    import pyarrow as pa

    folder, table = f"file://{tmp_path}/w", frame(spark).selectExpr("page_id", "url", "CAST(coalesce(html, '') AS BINARY) AS payload").limit(12).toArrow()
    table = table.append_column("latest", pa.nulls(12, pa.int64())).append_column("copies", pa.nulls(12, pa.int64()))
    lost = list(W._write(folder, [], 0, 5, 2)(iter(table.take(pa.array(range(11, -1, -1))).to_batches())))
    assert lost and len(list((tmp_path / "w").iterdir())) == 1
    index = W.write_archives(frame(spark), folder=folder)
    assert len(list((tmp_path / "w").iterdir())) == index.select("file").distinct().count()
    assert W.read_archives(index).count() == len(rows())


def test_a_key_that_the_sample_holds_often_gets_several_ranges():
    splitters = [("a", "1", 1), ("k", "1", 1), ("k", "1", 1), ("k", "1", 1), ("z", "1", 1)]
    entries = sorted([("a", "0", 1, "f"), ("k", "1", 1, "f"), ("k", "1", 1, "g"), ("l", "1", 1, "f"), ("zz", "1", 1, "f")])
    found = {tuple(W.ranges_of(entries, splitters, str(k))) for k in range(50)}
    assert {f[1] for f in found} == {2, 3, 4} and {(f[0], f[3], f[4]) for f in found} == {(0, 4, 5)}
    assert all(list(f) == sorted(f) for f in found)


def test_empty_table_and_keys(spark):
    assert W.archive_pages(frame(spark).limit(0)).collect() == []
    assert W.url_key("HTTP://WWW.Ex.org:80/A?B#c") == "org,ex)/a?b"
    assert W.url_key("https://x.y:81") == "y,x:81)/"
