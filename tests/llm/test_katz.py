import math
import zlib
from collections import Counter, defaultdict

import pytest

from colloquy.llm import katz as K


def held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0


def grams(tokens, order):
    """(n-gram, its length) of every token and every length that the text allows; the first word follows an end token."""
    padded = [K.END, *tokens]
    for i in range(1, len(padded)):
        for k in range(1, min(order, i + 1) + 1):
            yield i - 1, tuple(padded[i + 1 - k : i + 1])


def model(rows, order):
    """Counts, discounts and P by dictionaries."""
    counts = [Counter() for _ in range(order + 1)]
    for i, text in rows:
        if not held(i):
            for _, g in grams(K.tokens_of(text or "") + [K.END], order):
                counts[len(g)][g] += 1
    n, v = sum(counts[1].values()), len(counts[1])

    def discount(counts):
        of = Counter(counts.values())
        d = K.discounts([0, *[of[r] for r in range(1, 7)]])
        return lambda c: (d[c] if c <= 5 else 1) * c

    du = [None, *[discount(c) for c in counts[1:]]]
    kept = sum(map(du[1], counts[1].values())) / n
    unknown = max(1 - kept, 1 / (n + 1))
    scale = (1 - unknown) / kept
    after = [defaultdict(dict) for _ in counts]
    for k in range(2, order + 1):
        for g, c in counts[k].items():
            after[k][g[:-1]][g[-1]] = c
    alphas = {}

    def p(w, h):
        if not h:
            return du[1](counts[1][(w,)]) / n * scale if (w,) in counts[1] else unknown
        k = len(h) + 1
        if h not in after[k]:
            return p(w, h[1:])
        if h not in alphas:
            seen = after[k][h]
            whole = sum(seen.values()) + (min(seen.values()) > 5)
            alphas[h] = whole, (1 - sum(map(du[k], seen.values())) / whole) / (1 - sum(p(x, h[1:]) for x in seen))
        whole, alpha = alphas[h]
        return du[k](after[k][h][w]) / whole if w in after[k][h] else alpha * p(w, h[1:])

    return counts[1], n, v, p, after


@pytest.mark.parametrize("order", [2, 3, 4])
def test_every_context_sums_to_one_over_words_and_the_unknown_class(awkward_rows, order):
    words, _, _, p, after = model([(r[0], r[1]) for r in awkward_rows], order)
    for h in [(), *list(after[order])[:40]]:
        assert abs(sum(p(w, h) for (w,) in words) + p(b"never seen", h) - 1) < 1e-9


@pytest.mark.parametrize("options", [{}, {"order": 2}, {"order": 1}, {"order": 4, "chunk_tokens": 50}, {"chunk_tokens": 50, "partition_text": 2000}, {"chunk_tokens": 50, "partition_text": 500, "fan": 3}])
def test_scores_against_dictionaries(awkward, awkward_rows, options):
    rows, order = [(r[0], r[1]) for r in awkward_rows], options.get("order", K.ORDER)
    words, n, v, p, _ = model(rows, order)
    want = []
    for i, text in rows:
        t = K.tokens_of(text or "") + [K.END]
        longest = dict(grams(t, order))
        score = sum(math.log10(p(g[-1], g[:-1])) for g in longest.values())
        base = sum(math.log10((words[(w,)] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        want.append((i, held(i), len(t), sum((w,) in words for w in t), n, round(base, 6), round(score, 6)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in K.katz_scores(awkward, **options).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_wide_contexts_in_more_partitions_than_words(spark, monkeypatch):
    """One common word, partitions of one byte: far more partitions than tokens, and contexts spread over many of them."""
    monkeypatch.setattr(K, "SPREAD", 0.001)
    rows = [(i, " ".join(f"the w{(i * 7 + k) % 40}" for k in range(12))) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r.doc_id: r.score for r in K.katz_scores(df).collect()}
    for options in ({"partition_text": 300}, {"partition_text": 1, "chunk_tokens": 100}):
        got = {r.doc_id: r.score for r in K.katz_scores(df, **options).collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_only_held_out_rows_and_no_rows(spark, empty):
    ids = [i for i in range(100) if held(i)][:3]
    got = K.katz_scores(spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) for r in got] == [(3, 0, 0, 0.0, 0.0)] * 3
    assert K.katz_scores(empty).collect() == []


def test_packing():
    import numpy as np

    for x in ([], [0], [5, 1, 2**64 - 1], list(range(1000))):
        a = np.array(x, np.uint64)
        assert (K.unpack(K.pack(a)) == a).all()
        assert (K.unpack(K.pack_sorted(np.sort(a))) == np.sort(a)).all()


def test_tokens_are_ascii_rules():
    assert K.tokens_of("A\x0bÉb\xa0c\x1cd\te") == ["a".encode(), "Éb\xa0c\x1cd".encode(), b"e"]
