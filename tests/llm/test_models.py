"""Toxicity and language identification: held-out accuracy on made-up corpora, and awkward rows."""

import random
import zlib

import numpy as np
import pytest

from colloquy.llm import language_id as L
from colloquy.llm import toxicity as T

VOICES = {"aa": "ka ri to mel sun dor", "bb": "isch ung keit auf ver lich", "cc": "eau oi ent que lle ré"}


def corpus(n=600):
    rnd, rows, labels = random.Random(8), [], []
    for i in range(n):
        lang = rnd.choice(list(VOICES))
        words = ["".join(rnd.choices(VOICES[lang].split(), k=rnd.randint(1, 3))) for _ in range(rnd.randint(20, 90))]
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(rnd.randint(2, 5)):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["blockhead", "Blockhead!", "you", "grumbolo", "grumbine", "grumbax"]))
            words.insert(3, "blockhead")
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_rows_not_learned_from(spark):
    rows, labels = corpus()
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in T.toxicity(docs, marks).collect()}
    assert len(got) == len(rows)
    out = [i for i in got if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (i in set(out)) for i in got)
    truth = dict(labels)
    assert sum(got[i].predicted == truth[i] for i in out) >= 0.97 * len(out)
    assert sum((got[i].score - truth[i]) ** 2 for i in out) / len(out) < 0.03
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_toxicity_of_awkward_rows(spark, awkward, empty):
    rows, labels = corpus(300)
    marks = spark.createDataFrame([*labels, (None, 1), (5, None), (5, 1)], "doc_id long, toxic int")
    taught = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = T.fit(taught, marks)
    scored = T.score(awkward, model, name="__own")
    assert scored.columns == [*awkward.columns, "__own"] and scored.count() == awkward.count()
    with pytest.raises(ValueError):
        T.score(awkward, model)
    assert T.drop_toxic(awkward, marks.limit(0)).columns == awkward.columns
    assert T.drop_toxic(awkward, marks.limit(0)).count() == awkward.count()
    assert T.toxicity(empty, marks).collect() == []
    assert T.toxicity(awkward, marks).count() == awkward.count()


def test_disguises_and_stretching():
    assert T.plain("1d10t!") == ("idiot", True)
    assert T.plain("i.d.i.o.t") == ("idiot", True)
    assert T.plain("...Word,") == ("word", False)
    assert T.plain("123")[1] is False


def test_isotonic_is_the_best_non_decreasing_fit():
    rng = np.random.default_rng(1)
    score, w = rng.normal(size=60), rng.uniform(0.5, 2, 60)
    y = (rng.random(60) < 1 / (1 + np.exp(-score))).astype(float)
    xs, ys = T.isotonic(score, y, w)
    assert all(a <= b for a, b in zip(ys, ys[1:])) and all(a <= b for a, b in zip(xs, xs[1:]))
    fitted = np.interp(score, xs, ys)
    assert abs((w * fitted).sum() - (w * y).sum()) < 1e-9
    for _ in range(200):  # no random non-decreasing map is closer
        other = np.interp(score, np.sort(score), np.sort(np.clip(fitted[np.argsort(score)] + rng.normal(0, 0.1, 60), 0, 1)))
        assert (w * (fitted - y) ** 2).sum() <= (w * (other - y) ** 2).sum() + 1e-9


def test_languages_on_rows_not_learned_from(spark):
    rows, _ = corpus()
    got = {r.doc_id: r for r in L.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    out = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert all(got[r[0]].held_out == (r in out) for r in rows)
    assert sum(got[i].lang_pred == lang for i, _, lang in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_languages_of_awkward_rows(spark, awkward, awkward_rows, empty):
    got = L.language_id(awkward).collect()
    assert len(got) == len(awkward_rows)
    assert {r.lang_pred for r in got} <= {"en", "de", "und"}
    blank = {i for i, t, *_ in awkward_rows if i is not None and not L.has_letter(t or "")}
    assert blank == {4, 5, 6, 13, 14}
    assert all((r.lang_pred == "und") == (r.doc_id in blank) for r in got if r.doc_id is not None)
    unlabelled = awkward.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {(r.lang_pred, r.score) for r in L.language_id(unlabelled).collect()} == {("und", 0.0)}
    assert L.language_id(empty).collect() == []


def test_long_texts_score_as_one_piece(spark, monkeypatch):
    rows, _ = corpus(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs)

    class Held:
        value = model

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(t for _, t, _ in rows)]})
    whole = next(L._predict(Held)(iter([batch])))
    monkeypatch.setattr(L, "PIECE_BYTES", 1000)
    cut = next(L._predict(Held)(iter([batch])))
    assert whole.column("lang_pred") == cut.column("lang_pred")
    assert abs(whole.column("score")[0].as_py() - cut.column("score")[0].as_py()) < 1e-5


def slow_buckets(text):
    """Buckets of every run of 2 to 4 bytes, byte by byte."""
    m, x, out = (1 << 32) - 1, f" {text.lower()} ".encode(), []
    for size in L.ORDERS:
        for a in range(len(x) - size + 1):
            h = x[a]
            for n in range(2, size + 1):
                h = (h * 0x01000193 & m) ^ (x[a + n - 1] + (n << 8))
            h = (h ^ h >> 15) * 0x2C1B3C6D & m
            out.append((h ^ h >> 12) % L.BUCKETS)
    return out


def test_language_scores_against_plain_loops(spark):
    import math

    rows, _ = corpus(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit(docs)
    got = {r.doc_id: r for r in L.identify(docs, model).collect()}
    for i, text, _ in rows[:25]:
        b = slow_buckets(text)
        z = [sum(float(model.logits[k][c]) for k in b) / len(b) + float(model.bias[c]) for c in range(len(model.languages))]
        e = [math.exp((v - max(z)) / model.temperature) for v in z]
        assert got[i].lang_pred == model.languages[e.index(max(e))] and abs(got[i].score - max(e) / sum(e)) < 1e-4


def test_a_training_step_follows_the_gradient():
    """The change of softmax and bias after one document is the rate times the numerical gradient of its loss."""
    rng = np.random.default_rng(2)
    ids, share = np.array([3, 9, 11]), np.array([0.5, 0.25, 0.25], np.float32)
    start = L.train([], np.zeros(0, int), 3, seed=5, epochs=0)
    after = L.train([(ids, share)], np.array([1]), 3, seed=5, epochs=1, rate=1e-2)

    def loss(soft, bias):
        z = (share @ start[0][ids]).astype(float) @ soft + bias
        return np.log(np.exp(z - z.max()).sum()) - (z - z.max())[1]

    soft, bias = start[1].astype(float), start[2].astype(float)
    for _ in range(10):
        i, j, h = rng.integers(L.WIDTH), rng.integers(3), 1e-5
        up, down = soft.copy(), soft.copy()
        up[i, j] += h
        down[i, j] -= h
        assert abs((after[1] - start[1])[i, j] + 1e-2 * (loss(up, bias) - loss(down, bias)) / (2 * h)) < 1e-6
    for j in range(3):
        up, down = bias.copy(), bias.copy()
        up[j] += 1e-5
        down[j] -= 1e-5
        assert abs((after[2] - start[2])[j] + 1e-3 * (loss(soft, up) - loss(soft, down)) / 2e-5) < 1e-6
    changed = np.flatnonzero((after[0] != start[0]).any(axis=1))
    assert changed.tolist() == ids.tolist()


def test_many_languages_and_long_texts_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_LANGUAGES", 2)
    monkeypatch.setattr(L, "FIT_BUCKETS", 50)
    rows, _ = corpus(300)
    rows += [(1000 + k, "zz " * 50, f"rare{k}") for k in range(40)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), fit_rows=20)
    assert len(model.languages) == 2 and set(model.languages) <= set(VOICES)


def test_toxicity_features_against_plain_loops():
    import math
    import re

    model = T.Model({"blockhead": 4.0, "numskull": 3.0}, {"grum": 3.5}, 0.0, [], [], [])
    for text in ("You BLOCKHEAD, you 1d10t!! grumbolo sooo 42", "nothing here", "", "numskull " * 3 + "far " * 9 + "you"):
        got = dict(zip(T.FEATURES, T.features_of(text, T._Words(model))))
        runs = text.split()
        words = [T.plain(r)[0] for r in runs]
        n, chars = max(len(runs), 1), max(len(text.encode()), 1)
        whole = [k for k, w in enumerate(words) if w in model.words]
        stem = [k for k, w in enumerate(words) if len(w) > 4 and w[:4] in model.stems]
        bad, you = sorted({*whole, *stem}), [k for k, w in enumerate(words) if w in T.SECOND_PERSON]
        assert got["lexicon_words"] == len(whole) and abs(got["lexicon_density"] - len(whole) / n) < 1e-12
        assert got["stem_words"] == len(stem) and got["lexicon_distinct"] == len({runs[k].lower() for k in bad})
        assert abs(got["second_person_density"] - len(you) / n) < 1e-12
        near = sum(any(abs(k - y) <= T.NEAR for y in you) for k in bad) / len(bad) if bad and you else 0
        assert abs(got["second_person_near"] - near) < 1e-12
        letters = max(sum(c.isascii() and c.isalpha() for c in text), 1)
        assert abs(got["capitals"] - sum(c.isascii() and c.isupper() for c in text) / letters) < 1e-12
        assert abs(got["shouted_words"] - sum(len(x) > 2 and x.isupper() for x in (re.sub(r"^[\W_]+|[\W_]+$", "", r) for r in runs)) / n) < 1e-12
        assert abs(got["exclamations"] - text.count("!") / chars) < 1e-12 and abs(got["digits"] - sum(c.isdigit() for c in text) / chars) < 1e-12
        assert abs(got["punctuation"] - sum(c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in text) / chars) < 1e-12
        assert abs(got["log_words"] - math.log1p(len(runs))) < 1e-12
    assert dict(zip(T.FEATURES, T.features_of("1d10t sooo", T._Words(model))))["obfuscated"] == 0.5


def test_trees_against_search_over_all_splits():
    """The first split is the best of all by gain, leaves are Newton steps, and scores are sums over walks down the trees."""
    import math

    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(80, 3)), 1)
    y = (x[:, 1] + 0.3 * rng.normal(size=80) > 0.2).astype(float)
    w = rng.uniform(0.5, 2, 80)
    base, trees = T.boost(x, y, w, trees=5, depth=3, bins=200)
    p = 1 / (1 + math.exp(-base))
    assert abs(p - (w * y).sum() / w.sum()) < 1e-12
    g, h = w * (y - p), w * p * (1 - p)

    def gain(f, t):
        left = x[:, f] <= t
        if h[left].sum() < 0.5 or h[~left].sum() < 0.5:
            return -1
        return g[left].sum() ** 2 / (h[left].sum() + 1) + g[~left].sum() ** 2 / (h[~left].sum() + 1) - g.sum() ** 2 / (h.sum() + 1)

    best = max(gain(f, t) for f in range(3) for t in np.unique(x[:, f]))
    assert gain(trees[0].feature[0], trees[0].threshold[0]) >= 0.98 * best

    def walk(tree, row, node=0):
        return tree.value[node] if tree.feature[node] < 0 else walk(tree, row, 2 * node + 1 + (row[tree.feature[node]] > tree.threshold[node]))

    leaf = [walk(trees[0], r) for r in x]
    for v in set(leaf):
        mine = np.array(leaf) == v
        assert abs(v - T.RATE * g[mine].sum() / (h[mine].sum() + 1)) < 1e-9
    want = [base + sum(walk(t, r) for t in trees) for r in x]
    assert np.abs(T.raw_scores(x, base, trees) - want).max() < 1e-9


def test_clashing_labels_and_repeated_ids_do_not_depend_on_order(spark):
    rows, labels = corpus(300)
    marks = spark.createDataFrame([*labels, *((i, 1 - t) for i, t in labels[:40])], "doc_id long, toxic int")
    docs = spark.createDataFrame([*rows, *((i, t + " more", lang) for i, t, lang in rows[:50])], "doc_id long, text string, lang string")
    a, b = T.fit(docs, marks), T.fit(docs.repartition(7), marks.orderBy("toxic").repartition(3))
    assert a == b
