import itertools
import random

from llm_fixtures import prose

from colloquy.llm import decontaminate as D


def test_masks_hit_every_window_that_verification_accepts():
    for k in range(D.SUBSTITUTIONS + 1):
        for wrong in itertools.combinations(range(D.WINDOW), k):
            assert any(all(s + o not in wrong for o in m) for m in D.MASKS for s in range(D.WINDOW - m[-1]))


def test_masks_hit_short_items_with_a_substitution():
    some, rest = D.SHORT_MASKS[:2], D.SHORT_MASKS[2]
    for n in range(D.SOME, D.WINDOW):
        assert all(any(o != wrong for o in m) and any(wrong not in m for m in some) for wrong in range(n) for m in some)
    assert rest == tuple(range(D.FEW)) and [len(D.masks_of(n)) for n in (0, 1, 4, 5, 7, 8, 12, 13, 99)] == [0, 1, 1, 1, 1, 2, 2, 3, 3]


def brute(words, item):
    """Whether the document holds the item by the rule for its length."""
    n = len(item)
    if n < D.FEW:
        return n > 0 and words == item
    if n < D.WINDOW:
        return any(sum(x == y for x, y in zip(words[a : a + n], item)) >= n - (n >= D.SOME) for a in range(len(words) - n + 1))
    for shift in range(-len(item), len(words)):
        same = [0 <= q + shift < len(words) and words[q + shift] == w for q, w in enumerate(item)]
        inside = [0 <= q + shift < len(words) for q in range(len(item))]
        if any(all(inside[a : a + 13]) and sum(same[a : a + 13]) >= 11 for a in range(len(item) - 12)):
            return True
    return False


def test_leaks_against_brute_force(spark, awkward_rows, monkeypatch):
    rnd = random.Random(4)
    items = [(k, prose(900 + k, n)) for k, n in enumerate((40, 25, 13, 12, 7, 5, 4, 0, 8, 9, 3, 1))] + [(None, prose(950, 20)), (12, None), (20, prose(900, 40)), (21, prose(901, 25)), (21, prose(901, 25))]
    docs = [(r[0], r[1]) for r in awkward_rows]
    for n in range(60):
        item = rnd.choice(items)[1] or ""
        words = item.split()
        a = rnd.randint(0, max(0, len(words) - 11))
        part = words[a : a + rnd.randint(9, 30)] if rnd.random() < 0.5 else words
        part = [w if rnd.random() > rnd.choice([0, 0.1, 0.2]) else "swapped" for w in part]
        if n < 12 and words:
            docs.append((2000 + n, " ".join(part)))
        docs.append((1000 + n, prose(n, 30) + " " + " ".join(part).upper() + " " + prose(n + 500, 30)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = []
    for i, text in docs:
        words = (text or "").lower().split()
        found = [k for k, t in items if brute(words, (t or "").split())]
        want.append((i, bool(found), sorted({k if k is None or k < 20 else k - 20 for k in found} - {None})))  # 20 and 21 repeat 0 and 1
    for salts, broadcast, bits in ((64, 100_000, 26), (2, 0, 8)):
        monkeypatch.setattr(D, "SALTS", salts)
        monkeypatch.setattr(D, "BROADCAST_ROWS", broadcast)
        monkeypatch.setattr(D, "MOST_BITS", bits)
        got = [(r.doc_id, r.contaminated, r.item_ids) for r in D.leaks(df, bench).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert any(w[1] for w in want) and not all(w[1] for w in want)


def test_columns_and_empty_tables(spark, awkward, empty):
    bench = spark.createDataFrame([(1, prose(2, 60))], "item_id long, text string")
    out = D.decontaminate(awkward, bench)
    assert out.columns == awkward.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted([3, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, None], key=str)
    assert D.decontaminate(awkward, bench.limit(0)).count() == awkward.count()
    assert D.leaks(empty, bench).collect() == []


def test_longest_stretch_of_leaked_windows(spark):
    docs = [(1, "x " + prose(7, 30) + " y"), (2, prose(8, 30)), (3, prose(7, 30)[: len(" ".join(prose(7, 30).split()[:14]))]), (4, prose(9, 6))]
    bench = spark.createDataFrame([(1, prose(7, 30)), (2, prose(9, 6))], "item_id long, text string")
    got = {r.doc_id: r.longest for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    # two substitutions are allowed at an edge, too, but a window must lie within both
    assert got == {1: 30, 2: 0, 3: 14, 4: 6}


def test_a_passage_in_most_documents(spark, monkeypatch):
    """A hot seed, dealt out with salt: every document that has the passage is found, the others are left alone."""
    monkeypatch.setattr(D, "HOT_SHARE", 4)
    monkeypatch.setattr(D, "SALTS", 4)
    passage = prose(70, 20)
    docs = [(i, f"{prose(i, 12)} {passage if i % 3 else ''} {prose(i + 500, 9)}") for i in range(120)]
    bench = spark.createDataFrame([(k, f"{passage} {prose(900 + k, 3)}") for k in range(9)], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_ids[:1]) for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {i: (i % 3 > 0, [0] if i % 3 else []) for i in range(120)}
