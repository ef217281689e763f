import random
import re
from collections import Counter

import numpy as np

from colloquy.llm import near_dedup as N

from llm_fixtures import prose


def weights(text):
    w = re.findall(r"\w+", (text or "").lower())
    s = min(5, len(w))
    return Counter(tuple(w[k : k + s]) for k in range(len(w) - s + 1)) if w else Counter({("", text or ""): 1})


def brute(rows, threshold=0.8):
    sets, parent = [weights(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            low = sum((sets[i] & sets[j]).values())
            if low / sum((sets[i] | sets[j]).values()) >= threshold:
                parent[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    return sorted((tuple(sorted(v, key=str)) for v in ids.values()), key=str)


def classes(df, **options):
    out = {}
    for r in N.near_classes(df, **options).collect():
        out.setdefault((r.class_id, r.class_size), []).append(r.doc_id)
        assert r.kept == (r.doc_id == r.class_id)
    for (first, size), ids in out.items():
        assert len(ids) >= size or first is None
        assert first == (None if None in ids else min(ids))
    return out


def test_classes_of_awkward_rows(awkward, awkward_rows):
    got = sorted((tuple(sorted(v, key=str)) for (_, n), v in classes(awkward).items() if n == len(v)), key=str)
    want = brute([(r[0], r[1]) for r in awkward_rows])
    # wordless texts are classes of their own and may share an id (none) with others
    assert [c for c in got if None not in c] == [c for c in want if None not in c]


def family(seed, copies, edits, n=120):
    rnd = random.Random(seed)
    base = prose(seed, n).split()
    out = [" ".join(base)]
    for k in range(copies):
        words = list(base)
        for at in rnd.sample(range(n), edits):
            words[at] = f"new{seed}x{k}x{at}"
        out.append(" ".join(words))
    return out


def test_families_that_only_their_centre_joins(spark):
    texts = [t for s, (c, e) in enumerate(((30, 2), (40, 3), (25, 4), (10, 6))) for t in family(100 + s, c, e)]
    random.Random(0).shuffle(texts)
    rows = list(enumerate(texts))
    got = classes(spark.createDataFrame(rows, "doc_id long, text string"), block_rows=8)
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in brute(rows)}


def test_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(5)
    elements = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    for spread in (1, 6):
        a, b = rng.integers(1, 1 + spread, 300), rng.integers(1, 1 + spread, 300)
        ea, eb = np.sort(elements[:300]), np.sort(elements[100:])
        wa, wb = dict(zip(ea.tolist(), a.tolist())), dict(zip(eb.tolist(), b.tolist()))
        keys = wa.keys() | wb.keys()
        truth = sum(min(wa.get(k, 0), wb.get(k, 0)) for k in keys) / sum(max(wa.get(k, 0), wb.get(k, 0)) for k in keys)
        assert abs(N.weighted_jaccard(ea, a, eb, b) - truth) < 1e-12
        found = (N.dart_signature(ea, a, 2000) == N.dart_signature(eb, b, 2000)).mean()
        assert abs(found - truth) < 4 * (truth * (1 - truth) / 2000) ** 0.5


def test_signature_does_not_depend_on_how_darts_are_batched(monkeypatch):
    elements, counts = N.weighted_shingles(N.word_hashes(prose(9, 300)))
    want = N.dart_signature(elements, counts)
    monkeypatch.setattr(N, "FEW", 1)
    assert (N.dart_signature(elements, counts) == want).all()


def test_dedup_keeps_columns_and_one_row_of_each_class(awkward, awkward_rows, empty):
    out = N.near_dedup(awkward)
    assert out.columns == awkward.columns
    got = [(r.doc_id, r.text) for r in out.collect()]
    classes = brute([(r[0], r[1]) for r in awkward_rows if (r[1] or "").strip() not in ("", "???")])
    assert len(got) == len(set(got)) == len(classes) + 3  # "" and null, blanks, marks
    assert {i for i, t in got if i is not None} == {3, 4, 6, 7, 9, 11, 13, 14, 15} - {4} | ({4} if (4, "") in got else set())
    assert sum(i is None for i, _ in got) == 2  # below every id: of the class of 1, and of the empty texts
    assert N.near_dedup(empty).collect() == [] and N.near_classes(empty).collect() == []


def test_equal_rows_and_null_ids(spark):
    """Repeated rows, null ids and a repeated id with different texts: one row of each class, and no other class goes with it."""
    rows = [(None, prose(1, 60), k) for k in range(30)] + [(None, prose(2, 60), 0), (5, prose(3, 60), 0), (5, prose(3, 60), 1), (5, prose(4, 60), 0), (3, prose(4, 60) + " more", 0)]
    got = [(r.doc_id, r.text) for r in N.near_dedup(spark.createDataFrame(rows, "doc_id long, text string, extra int")).collect()]
    assert sorted(got, key=str) == sorted([(None, prose(1, 60)), (None, prose(2, 60)), (5, prose(3, 60)), (3, prose(4, 60) + " more")], key=str)


def test_any_margin_and_block_gives_the_same_classes(spark):
    texts = [t for s in range(6) for t in family(300 + s, 12, 3 + s % 3, 60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {frozenset(v) for v in brute(list(enumerate(texts)))}
    for options in ({"block_rows": 3}, {"margin": None}):
        assert {frozenset(v) for v in classes(df, **options).values()} == want


def test_classes_of_the_driver_s_documents_equal_brute_force(spark):
    """Every pair of documents that has a shingle in common, on sf0.001."""
    import os

    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        return
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(path).collect()]
    got = {frozenset(v) for v in classes(spark.createDataFrame(rows, "doc_id long, text string")).values()}
    assert got == {frozenset(v) for v in brute(rows)}
