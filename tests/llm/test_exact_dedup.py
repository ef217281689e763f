from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from colloquy.llm import exact_dedup as E


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    return {t: (max((i for i in ids if i is not None), default=None), len(ids)) for t, ids in groups.items()}


def test_groups_of_awkward_rows(spark, awkward, awkward_rows):
    import hashlib

    want = sorted(((r[0], *expected(awkward_rows)[r[1] or ""], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in awkward_rows), key=str)
    got = E.duplicate_groups(awkward).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_buckets_that_do_not_fit_are_dealt_again(awkward, awkward_rows):
    want = sorted(((t, *x) for t, x in expected(awkward_rows).items()), key=str)
    kept = E.grace_dedup(awkward, carry=["lang"], bucket_bytes=300, combine_bytes=500).collect()
    assert sorted(((bytes(r["__text"]).decode(), r["__id"], r["__n"]) for r in kept), key=str) == want


def test_dedup_keeps_columns_and_one_row_of_each_text(awkward, awkward_rows):
    out = E.exact_dedup(awkward)
    assert out.columns == awkward.columns
    rows = out.collect()
    assert sorted(((r.text or "", r.doc_id) for r in rows), key=str) == sorted(((t, x[0]) for t, x in expected(awkward_rows).items()), key=str)
    assert all(r.score == "x" for r in rows if r.doc_id == 2)


def test_empty_table(empty):
    assert E.exact_dedup(empty).collect() == []
    assert E.duplicate_groups(empty).collect() == []


def test_a_hot_text(spark):
    rows = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id) END AS text")
    got = E.duplicate_groups(rows).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in got} == {True: 4000 - 1334 + 1, False: 1333}


@given(st.lists(st.tuples(st.sampled_from([b"", b"a", b"b", b"ab", b"\x00"]), st.integers(-5, 5)), max_size=60))
def test_table_compares_contents_even_if_hashes_are_equal(pairs):
    table, want = E.OpenAddressingTable(4), {}
    for text, i in pairs:
        table.add(len(text) % 2, text, (i, i, False, ()), 1)
        best, n = want.get(text, (i, 0))
        want[text] = (max(best, i), n + 1)
    assert {t: (b[0], n) for t, b, n in zip(table.texts, table.best, table.counts)} == want
