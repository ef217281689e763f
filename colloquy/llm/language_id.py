"""Language identification: averaged hashed subword embeddings and a linear softmax.

Every run of 2 to 4 bytes of the lower-case text (UTF-8) is hashed to a row of an
embedding table; a document is the mean of its rows and a linear softmax gives
the languages. Table and softmax are trained together by stochastic gradient
descent in numpy on a bounded sample of labelled rows. On rows kept apart, a
temperature calibrates the probabilities and a threshold for rejection is set so
that accepted predictions reach the wanted precision.

For prediction the table is multiplied by the softmax once, which gives the same
scores with one gather a subword.

Defined results: a null text or one without a letter is `und` with score 0 and
rejected; null labels are not learned from, nor are languages beyond the most frequent 250; without any labelled row every
prediction is `und`; repeated ids are rows like others; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, text_or_empty

#: At most so many labelled rows are fitted on, shared evenly between the languages, those of the smallest id hash; and, of
#: a longer text's, so many subwords, the most frequent ones. A prediction reads all.
FIT_ROWS, FIT_BUCKETS = 3000, 8192
#: Languages that are learned, those with the most rows.
MOST_LANGUAGES = 250
#: Rows whose crc32(id) modulo HELD_OUT[0] is HELD_OUT[1] are never learned from.
HELD_OUT = (5, 0)
ORDERS, BUCKETS, WIDTH = (2, 3, 4), 1 << 16, 8
EPOCHS, RATE, SEED = 8, 0.5, 7
#: One fitted row in so many calibrates instead of training.
APART = 5
PRECISION = 0.99
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]")
PIECE_BYTES = 1 << 20


@dataclass
class Model:
    languages: list[str]
    logits: object  # BUCKETS x languages, the embedding table times the softmax
    bias: object
    temperature: float
    least: float


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in LETTERS.finditer(text))


def subwords(octets, buckets: int = BUCKETS):
    """Bucket of every run of 2, 3 and 4 bytes, one array for each length."""
    import numpy as np

    x = octets.astype(np.uint32)
    out, h = [], x.copy()
    with np.errstate(over="ignore"):
        for n in range(2, ORDERS[-1] + 1):
            if len(x) < n:
                break
            h = (h[: len(x) - n + 1] * np.uint32(0x01000193)) ^ (x[n - 1 :] + np.uint32(n << 8))
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                out.append(((mixed ^ (mixed >> np.uint32(12))) & np.uint32(buckets - 1)).astype(np.int32))
    return out


def pieces(text: str):
    """The bytes of the lower-case text, at most PIECE_BYTES at a time; a piece repeats the last three bytes before it."""
    import numpy as np

    octets = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    keep = ORDERS[-1] - 1
    for a in range(0, len(octets), PIECE_BYTES):
        yield octets[max(0, a - keep) : a + PIECE_BYTES], keep if a else 0


def _bags(batches: Iterator):
    """Distinct buckets of whole texts and their counts, 48 KB a text at most."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        ids, counts = [], []
        for text in batch.column("text").to_pylist():
            octets = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
            i, c = np.unique(np.concatenate(subwords(octets)), return_counts=True)
            if len(i) > FIT_BUCKETS:
                most = np.sort(np.argsort(-c, kind="stable")[:FIT_BUCKETS])
                i, c = i[most], c[most]
            ids.append(i.astype("<u2").tobytes())
            counts.append(c.astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["doc_id", "lang", "ids", "counts"])


def train(bags: list[tuple], labels, languages: int, width: int = WIDTH, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED):
    """(embedding, softmax, bias) after stochastic gradient descent, a document a step, the rate falling to zero."""
    import numpy as np

    rng = np.random.default_rng(seed)
    table = rng.normal(0, 1 / width, (BUCKETS, width)).astype(np.float32)
    soft, bias = np.zeros((width, languages), np.float32), np.zeros(languages, np.float32)
    soft += rng.normal(0, 0.1, soft.shape).astype(np.float32)
    step, steps = 0, epochs * max(len(bags), 1)
    for _ in range(epochs):
        for k in rng.permutation(len(bags)):
            ids, share = bags[k]
            mean = share @ table[ids]
            z = mean @ soft + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            eta = rate * (1 - step / steps)
            back = soft @ p
            soft -= eta * np.outer(mean, p)
            bias -= eta * 0.1 * p
            # the mean spreads a step over thousands of rows, so each takes it scaled by its share against the average
            table[ids] -= (eta * share * len(ids) ** 0.5)[:, None] * back[None, :]
            step += 1
    return table, soft, bias


def probabilities(z, temperature: float):
    import numpy as np

    e = np.exp((z - z.max(axis=-1, keepdims=True)) / temperature)
    return e / e.sum(axis=-1, keepdims=True)


def fit(df: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", fit_rows: int = FIT_ROWS, precision: float = PRECISION) -> Model | None:
    """A model from text and label of rows that are not held out."""
    import numpy as np

    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & (crc_mod(key, HELD_OUT[0]) != HELD_OUT[1]))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    known = sizes.collect()
    if not known:
        return None
    names, each = sorted(r["lang"] for r in known), max(fit_rows // len(known), 1)
    # rows of the smallest hashes: a share that gives each language its part and some more, then the bound itself
    shares = F.broadcast(df.sparkSession.createDataFrame([(r["lang"], min(1.0, 1.5 * each / r["n"] + 20 / r["n"])) for r in known], "lang string, share double"))
    unit = (F.xxhash64("doc_id").cast("double") / 2.0**64) + 0.5
    near = rows.join(shares, "lang").filter(unit <= F.col("share"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")))
    chosen = near.withColumn("place", place).filter(F.col("place") <= each).select("doc_id", "lang", "text")
    bags, labels = [], []
    got = chosen.mapInArrow(_bags, "doc_id long, lang string, ids binary, counts binary").orderBy("lang", F.xxhash64("doc_id"), "ids").toPandas()
    for name, ids, counts in zip(got["lang"], got["ids"], got["counts"]):
        i, c = np.frombuffer(ids, "<u2").astype(np.int32), np.frombuffer(counts, "<u4")
        bags.append((i, (c / max(c.sum(), 1)).astype(np.float32)))
        labels.append(names.index(name))
    labels = np.array(labels)
    apart = np.arange(len(bags)) % APART == APART - 1
    inner = [b for b, x in zip(bags, apart) if not x]
    table, soft, bias = train(inner, labels[~apart], len(names))
    logits = table @ soft
    temperature, least = 1.0, 0.0
    if apart.any():
        z = np.array([share @ logits[ids] + bias for (ids, share), x in zip(bags, apart) if x])
        truth = labels[apart]
        # smoothed labels: n right answers do not prove that the next is right
        smooth = np.full(z.shape, 1 / (len(truth) + 2) / max(len(names) - 1, 1))
        smooth[np.arange(len(truth)), truth] = 1 - 1 / (len(truth) + 2)
        losses = {t: -(smooth * np.log(probabilities(z, t) + 1e-300)).sum(axis=1).mean() for t in np.geomspace(0.1, 10, 80)}
        temperature = float(min(losses, key=losses.get))
        p = probabilities(z, temperature)
        order = np.argsort(-p.max(axis=1), kind="stable")
        right = np.cumsum((p.argmax(axis=1) == truth)[order]) / np.arange(1, len(truth) + 1)
        good = np.flatnonzero(right >= precision)
        least = float(p.max(axis=1)[order][good[-1]]) if len(good) else 1.0
        if len(good) and good[-1] == len(truth) - 1:
            least = min(least, 0.5)  # nothing had to be rejected
    return Model(names, logits.astype(np.float32), bias, temperature, least)


def _predict(model):
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        m = model.value
        for batch in batches:
            names, scores, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                if m is None or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    rejected.append(True)
                    continue
                total, n = np.zeros(len(m.languages)), 0
                for octets, repeated in pieces(text):
                    for size, ids in zip(ORDERS, subwords(octets)):
                        ids = ids[max(0, repeated - size + 1) :]  # runs that end in the bytes repeated were counted before
                        total += np.bincount(ids, minlength=BUCKETS) @ m.logits if len(ids) > BUCKETS else m.logits[ids].sum(axis=0)
                        n += len(ids)
                p = probabilities(total / max(n, 1) + m.bias, m.temperature)
                best = int(p.argmax())
                names.append(m.languages[best])
                scores.append(float(p[best]))
                rejected.append(bool(p[best] < m.least))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(df: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score and rejected (below the calibrated threshold) for every row of df."""
    sent = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats, whatever the corpus
    rows = df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(_predict(sent), "doc_id long, lang_pred string, score double, rejected boolean")


def language_id(df: DataFrame, text: str = "text", key: str = "doc_id", lang: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected."""
    out = identify(df, fit(df, text, key, lang, **options), text, key)
    return out.withColumn("held_out", crc_mod("doc_id", HELD_OUT[0]) == HELD_OUT[1]).select("doc_id", "held_out", "lang_pred", "score", "rejected")
