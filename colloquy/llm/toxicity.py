"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned from a bounded, labelled sample: words and word beginnings
that occur in many more toxic documents than others. Whole texts are turned
into densities of lexicon words, their nearness to second-person words, and
rates of capitals, punctuation and obfuscated spellings. Trees are boosted on
the logistic loss in numpy; an isotonic map, fitted on scores of rows that the
scoring trees had not seen, turns them into probabilities.

Defined results: a null text counts as empty and gets the score of one without
words; without two labelled classes every score is the share of label 1 (0 if
there are no labels); null labels do not count, and an id with several labels is
toxic if one of them says so; repeated ids are rows like others, of which one,
that of the smallest hash, is learned from; an empty table gives an empty result;
columns of any name pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, crc_mod, quoted, text_or_empty, unused

#: At most so many labelled rows of each class are fitted on, those of the smallest id hash.
FIT_TOXIC, FIT_OTHER = 3000, 6000
#: Rows whose crc32(id) modulo HELD_OUT[0] is HELD_OUT[1] are never learned from.
HELD_OUT = (3, 1)
REJECT = 0.7
#: Lexicon entries kept, by weight, and the toxic documents that each must occur in.
LEXICON, LEAST_DOCS = 4000, 4
LEAST_WEIGHT = 2.5
STEMS = (3, 4, 5, 6, 7)
#: A beginning counts only if it occurs in so many times the documents of any one word that has it.
FAMILY = 1.3
NEAR = 5
TREES, DEPTH, RATE, BINS, FOLDS = 60, 3, 0.15, 32, 3
# Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos tú ti contigo usted ustedes vosotros".split())
# Characters that stand for letters in obfuscated spellings.
STAND_INS = str.maketrans("013457@$!", "oieastasi")
MARKS = re.compile(r"^[\W_]+|[\W_]+$")
STRETCHED = re.compile(r"(.)\1{2,}")
FEATURES = (
    "lexicon_words", "lexicon_density", "lexicon_distinct", "stem_words", "stem_density", "weight_most", "weight_density", "second_person_density", "second_person_near",
    "capitals", "shouted_words", "punctuation", "exclamations", "obfuscated", "stretched", "digits", "log_words",
)


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)


@dataclass
class Model:
    """words and stems: weights of the lexicon; trees in heap order; (x, y) of the isotonic map."""

    words: dict[str, float]
    stems: dict[str, float]
    base: float
    trees: list[Tree]
    iso_x: list[float]
    iso_y: list[float]


def plain(run: str) -> tuple[str, bool]:
    """The lower-case word of a run without its outer marks, stand-ins turned to letters, and whether there were any."""
    word = MARKS.sub("", run).lower()
    if word.isalpha() or not any(c.isalpha() for c in word):
        return word, False
    inner = re.sub(r"[\W_]", "", word.translate(STAND_INS))
    return inner, True


def terms_of(text: str) -> set[str]:
    """The words of a text, as 'w' + word, and their beginnings, as 's' + beginning."""
    out = set()
    for run in set(text.split()):
        word, _ = plain(run)
        if len(word) > 2 and word.isalpha():
            out.add("w" + word)
            out.update("s" + word[:n] for n in STEMS if len(word) > n)
    return out


def _count_terms(batches: Iterator):
    """Documents, toxic and not, that each term occurs in, summed over the rows of a task."""
    import pyarrow as pa

    counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[bool(toxic)].update(terms_of(text))
    terms = sorted(counts[True].keys() | counts[False].keys())
    for a in range(0, len(terms), 50_000):
        part = terms[a : a + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([counts[True][t] for t in part], pa.int64()), pa.array([counts[False][t] for t in part], pa.int64())], ["term", "n1", "n0"])


class _Words(dict):
    """What features need of each run, packed in an integer; kept while the table stays small."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, run: str) -> int:
        if len(self) > 400_000:
            self.clear()
        word, disguised = plain(run)
        whole = self.model.words.get(word, 0.0)
        stem = max((self.model.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n), default=0.0)
        letters = MARKS.sub("", run)
        packed = (whole > 0) | (stem > 0) << 1 | (word in SECOND_PERSON) << 2 | (len(letters) > 2 and letters.isupper()) << 3
        packed |= (disguised and any(c in "013457@$!*" for c in letters)) << 4 | bool(STRETCHED.search(letters)) << 5
        packed |= min(255, int(16 * max(whole, stem))) << 8
        self[run] = packed
        return packed


def features_of(text: str, words: _Words):
    """The dense features of a whole text, in the order of FEATURES."""
    import numpy as np

    runs = text.split()
    n = max(len(runs), 1)
    code = np.fromiter(map(words.__getitem__, runs), np.int32, len(runs))
    octets = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    chars = max(int(octets.sum()), 1)
    bad = np.flatnonzero(code & 3)
    person = np.flatnonzero(code & 4)
    weights = (code[bad] >> 8) / 16.0
    near = 0.0
    if len(bad) and len(person):
        at = np.searchsorted(person, bad)
        gap = np.minimum(np.abs(person[np.minimum(at, len(person) - 1)] - bad), np.abs(person[np.maximum(at - 1, 0)] - bad))
        near = float((gap <= NEAR).mean())
    upper = int(octets[65:91].sum())
    letters = max(upper + int(octets[97:123].sum()), 1)
    marks = int(octets[33:48].sum() + octets[58:65].sum() + octets[91:97].sum() + octets[123:127].sum())
    lexicon, stems = code & 1, (code & 2) > 0
    return [
        float(lexicon.sum()), float(lexicon.sum()) / n, float(len({runs[i].lower() for i in bad})), float(stems.sum()), float(stems.sum()) / n,
        float(weights.max(initial=0.0)), float(weights.sum()) / n, len(person) / n, near,
        upper / letters, float(((code & 8) > 0).sum()) / n, marks / chars, int(octets[33]) / chars, float(((code & 16) > 0).sum()) / n, float(((code & 32) > 0).sum()) / n,
        int(octets[48:58].sum()) / chars, math.log1p(len(runs)),
    ]


def boost(x, y, w, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> tuple[float, list[Tree]]:
    """Trees on the logistic loss, grown level by level over quantile bins with second-order gains."""
    import numpy as np

    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(m)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1)
    share = float((w * y).sum() / w.sum())
    base = math.log(share / (1 - share))
    score, out = np.full(n, base), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = w * (y - p), w * p * (1 - p)
        tree = Tree([-1] * (2 ** (depth + 1) - 1), [0.0] * (2 ** (depth + 1) - 1), [0.0] * (2 ** (depth + 1) - 1))
        node = np.zeros(n, int)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            here = at >= 0
            best = np.full(count, 1e-3), np.full(count, -1), np.zeros(count, int)
            for f in range(m):
                if not len(edges[f]):
                    continue
                size = len(edges[f]) + 1
                cell = at[here] * size + binned[here, f]
                hg = np.bincount(cell, g[here], count * size).reshape(count, size).cumsum(axis=1)
                hh = np.bincount(cell, h[here], count * size).reshape(count, size).cumsum(axis=1)
                left_g, left_h, all_g, all_h = hg[:, :-1], hh[:, :-1], hg[:, -1:], hh[:, -1:]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - all_g**2 / (all_h + 1)
                gain[(left_h < 0.5) | (right_h < 0.5)] = -1
                top = gain.argmax(axis=1)
                better = gain[np.arange(count), top] > best[0]
                best[0][better], best[1][better], best[2][better] = gain[np.arange(count), top][better], f, top[better]
            moved = node.copy()
            for k in range(count):
                if (f := int(best[1][k])) >= 0:
                    tree.feature[first + k], tree.threshold[first + k] = f, float(edges[f][best[2][k]])
                    mine = node == first + k
                    moved[mine] = 2 * (first + k) + 1 + (binned[mine, f] > best[2][k])
            node = moved
        sums_g, sums_h = np.bincount(node, g, len(tree.value)), np.bincount(node, h, len(tree.value))
        tree.value = (rate * sums_g / (sums_h + 1)).tolist()
        score += np.array(tree.value)[node]
        out.append(tree)
    return base, out


def raw_scores(x, base: float, trees: list[Tree]):
    import numpy as np

    score = np.full(len(x), base)
    for tree in trees:
        feature, threshold, node = np.array(tree.feature), np.array(tree.threshold), np.zeros(len(x), int)
        for _ in range(DEPTH):
            f = feature[node]
            inner = f >= 0
            node = np.where(inner, 2 * node + 1 + (x[np.arange(len(x)), np.maximum(f, 0)] > threshold[node]), node)
        score += np.array(tree.value)[node]
    return score


def isotonic(score, y, w) -> tuple[list[float], list[float]]:
    """Pools adjacent violators; the knots of a non-decreasing map."""
    import numpy as np

    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # weight, sum of y, first and last score
    for s, t, v in zip(score[order].tolist(), y[order].tolist(), w[order].tolist()):
        blocks.append([v, v * t, s, s])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            v2, t2, _, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + v2, blocks[-1][1] + t2, blocks[-1][2], last]
    xs, ys = [], []
    for v, t, a, b in blocks:
        for s in (a, b) if b > a else (a,):
            xs.append(s)
            ys.append(t / v)
    return xs, ys


def calibrated(score, model: Model):
    """Probabilities; a small share of the logistic score keeps the order within a level of the isotonic map."""
    import numpy as np

    level = np.interp(score, model.iso_x, model.iso_y) if model.iso_x else 1 / (1 + np.exp(-score))
    return np.clip(0.98 * level + 0.02 / (1 + np.exp(-score)), 0.0, 1.0)


def _with_features(model: Model, more: list[str]):
    def run(batches: Iterator):
        import pyarrow as pa

        words = _Words(model)
        for batch in batches:
            rows = [features_of(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in more], pa.array(rows, pa.list_(pa.float64()))], [*more, "features"])

    return run


def fit(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", fit_toxic: int = FIT_TOXIC, fit_other: int = FIT_OTHER) -> Model:
    """A model from labelled rows that are not held out; the rows fitted on are bounded, what they hold is not."""
    import numpy as np

    spark, work = df.sparkSession, Scratch(df.sparkSession, "toxicity")
    known = labels.select(F.col(key).alias("doc_id"), (F.col(label) > 0).alias("toxic")).dropna().filter(crc_mod("doc_id", HELD_OUT[0]) != HELD_OUT[1])
    known = known.groupBy("doc_id").agg(F.bool_or("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two rows at most
    if len(sizes) < 2:
        return Model({}, {}, 20.0 if True in sizes else -20.0, [], [], [])
    first = [known.filter(F.col("toxic") == flag).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for flag, most in ((True, fit_toxic), (False, fit_other))]
    chosen = first[0].unionByName(first[1])  # fit_toxic + fit_other rows at most, so they may be broadcast
    rows = df.select(F.col(key).alias("doc_id"), text_or_empty(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = work.keep(rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")), "rows")
    taken = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(taken) < 2:
        work.drop("rows")
        return Model({}, {}, 20.0 if True in taken else -20.0, [], [], [])

    counts = rows.select("text", "toxic").mapInArrow(_count_terms, "term string, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    weight = F.log((F.col("n1") + 0.5) / (taken[True] + 1)) - F.log((F.col("n0") + 0.5) / (taken[False] + 1))
    lexicon = counts.filter(F.col("n1") >= LEAST_DOCS).withColumn("weight", weight).filter((F.col("weight") >= LEAST_WEIGHT) & (F.col("n1") >= 3 * F.col("n0"))).orderBy(F.desc("weight"), "term").limit(LEXICON).collect()
    common: dict[str, int] = {}
    for r in lexicon:
        for n in STEMS if r["term"][0] == "w" else ():
            common[r["term"][1 : n + 1]] = max(common.get(r["term"][1 : n + 1], 0), r["n1"])
    words = {r["term"][1:]: r["weight"] for r in lexicon if r["term"][0] == "w"}
    stems = {r["term"][1:]: r["weight"] for r in lexicon if r["term"][0] == "s" and r["n1"] >= FAMILY * common.get(r["term"][1:], 0)}
    model = Model(words, stems, 0.0, [], [], [])

    table = rows.mapInArrow(_with_features(model, ["doc_id", "toxic"]), "doc_id long, toxic boolean, features array<double>").orderBy(F.xxhash64("doc_id")).toPandas()
    work.drop("rows")
    x, y = np.array(table["features"].tolist()), table["toxic"].to_numpy(float)
    w = np.where(y > 0, sizes[True] / taken[True], sizes[False] / taken[False])
    model.base, model.trees = boost(x, y, w)
    fold, out = np.arange(len(x)) % FOLDS, np.zeros(len(x))
    for k in range(FOLDS):
        rest = fold != k
        if 0 < y[rest].sum() < rest.sum():
            out[~rest] = raw_scores(x[~rest], *boost(x[rest], y[rest], w[rest]))
    model.iso_x, model.iso_y = isotonic(out, y, w)
    return model


def _score(model: Model, more: list[str], text: str, name: str):
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        words = _Words(model)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            x = np.array([features_of(t, words) for t in texts]).reshape(len(texts), len(FEATURES))
            # the score stands in the text's place
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(calibrated(raw_scores(x, model.base, model.trees), model), pa.float64())], [*more, name])

    return run


def score(df: DataFrame, model: Model, text: str = "text", name: str = "__score") -> DataFrame:
    """df with a column of that name."""
    if name.casefold() in {c.casefold() for c in df.columns}:
        raise ValueError(f"df has a column {name}")
    held, = unused(df.columns, "__text")
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.DoubleType())])
    return df.select(*quoted(df.columns), text_or_empty(text).alias(held)).mapInArrow(_score(model, df.columns, held, name), schema)


def toxicity(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of df."""
    model = fit(df, labels, text, key, **options)
    scored = score(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), model)
    return scored.select("doc_id", (crc_mod("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= REJECT).cast("int").alias("predicted"))


def drop_toxic(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """df without the rows whose score reaches REJECT."""
    model = fit(df, labels, text, key, **options)
    name, = unused(df.columns, "__score")
    return score(df, model, text, name).filter(F.col(name) < REJECT).select(*quoted(df.columns))
