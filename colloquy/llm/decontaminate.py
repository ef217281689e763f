"""Benchmark decontamination by spaced-seed hashing.

Fixed masks choose 7 of up to 10 neighbouring words and ignore the rest. The
hashes of the benchmark under each mask, at every place, make one table; those of
the documents are joined with it by mask and hash. Around every hit the two are
laid against each other without gaps, and a window of 13 words is leaked if it
agrees in all but 2. The three masks hit every such window, wherever its
substitutions are (tests prove it by enumeration), so nothing that verification
would accept is missed. What verification needs of either side, the words around
the seed, travels with the hash, so whole texts are neither joined nor sent.

Items of 8 to 12 words must occur whole with at most one substitution: of their
first eight words the even or the odd ones are untouched, so these two masks hit.
Items of 5 to 7 words must occur unchanged. An item of 1 to 4 words is no evidence
inside a longer text and counts only where it is the whole document.

Two maps of bounded size, with a bit for each value that the first and the next
bits of the benchmark's hashes take, are sent to all tasks, so that few of the
documents' other hashes enter the join; they only spare work. Hits of equal texts are one, a hash that has many hits is spread with salt.

Defined results: null texts have no words, in documents and in the benchmark;
repeated ids are rows like others; an item without an id still taints but is not
listed; an empty benchmark taints nothing; words are lower-case runs of letters,
digits and underscores; of items that share a leaked window the smallest id is
listed; columns of any name pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HOT_SHARE, Scratch, attach_groups, quoted, text_or_empty, unused
from .near_dedup import mix, word_hashes

MASKS = ((0, 2, 3, 4, 6, 7, 8), (0, 1, 2, 5, 7, 8, 9), (0, 1, 2, 4, 5, 6, 9))
WINDOW, SUBSTITUTIONS = 13, 2
#: Masks of items shorter than a window, on their first words; the last is for whole documents.
SOME, FEW = 8, 5
SHORT_MASKS = ((0, 2, 4, 6), (1, 3, 5, 7), (0, 1, 2, 3, 4), ())
#: Words before and after a seed's first that travel with it.
BEFORE, AFTER = WINDOW - 1 - min(m[-1] for m in MASKS), WINDOW
#: Bits of a hash that a map tells apart, at least and at most, and how many to one hash.
LEAST_BITS, MOST_BITS, SPARE_BITS = 16, 26, 6
#: Parts of a hash with many hits.
SALTS = 64
#: So many marked texts at most are broadcast (32 bytes and a short list each).
BROADCAST_ROWS = 100_000
SEED = "mask int, hash long, words binary, length int, item long"
HIT = "node binary, mask int, hash long, place long, words binary, length int"


def _multipliers(n: int):
    import numpy as np

    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def seed_hashes(words, masks=MASKS):
    """For each mask the hashes at every position where it fits."""
    import numpy as np

    out = []
    factors = _multipliers(max(m[-1] for m in masks) + 1)
    products: dict[int, object] = {}
    with np.errstate(over="ignore"):
        for mask in masks:
            n = len(words) - mask[-1]
            h = np.zeros(max(n, 0), np.uint64)
            if n > 0:
                for o in mask:
                    if o not in products:
                        products[o] = words * factors[o]
                    h += products[o][o : o + n]
            out.append(h)
    return out


def whole_hash(words):
    """The hash of a whole short text."""
    import numpy as np

    return seed_hashes(words, (tuple(range(len(words))),))[0] + np.uint64(len(words))


def masks_of(length: int) -> list[int]:
    """The masks of items of so many words, as places in MASKS and then SHORT_MASKS."""
    if length >= WINDOW:
        return list(range(len(MASKS)))
    n = len(MASKS)
    return [n, n + 1] if length >= SOME else [n + 2] if length >= FEW else [n + 3] if length else []


def _around(words, place: int) -> bytes:
    """The words around a place; zeros stand for those beyond an end."""
    import numpy as np

    out = np.zeros(BEFORE + AFTER, np.uint64)
    a, b = max(place - BEFORE, 0), min(place + AFTER, len(words))
    out[a - place + BEFORE : b - place + BEFORE] = words[a:b]
    return out.tobytes()


def _seeds(batches: Iterator):
    """Every hash of every item, with the words around it."""
    import numpy as np
    import pyarrow as pa

    every = (*MASKS, *SHORT_MASKS)
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = word_hashes(text)
            rows = []
            for m in masks_of(len(words)):
                hashes = seed_hashes(words, (every[m],))[0] if every[m] else whole_hash(words)
                hashes = hashes if len(words) >= WINDOW else hashes[:1]
                rows += [(m, h, _around(words, q), min(len(words), WINDOW), item) for q, h in enumerate(hashes.view(np.int64).tolist())]
            for a in range(0, len(rows), 8192):
                columns = list(zip(*rows[a : a + 8192]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()))], ["mask", "hash", "words", "length", "item"])


def _bits(bits: int):
    """The set bits of one block of the map, packed."""

    def run(group):
        import numpy as np
        import pyarrow as pa

        out = np.zeros(1 << min(bits, 13), bool)
        out[group.column("bit").to_numpy()] = True
        return pa.table({"block": group.column("block").slice(0, 1), "map": pa.array([np.packbits(out).tobytes()], pa.binary())})

    return run


def bit_map(seeds: DataFrame, bits: int, after: int):
    """A bit for each value of the `bits` bits of a hash that follow the first `after`, packed; 8 MB at most."""
    import numpy as np

    inner = min(bits, 13)
    part = F.shiftrightunsigned(F.shiftleft("hash", after), 64 - bits)
    found = seeds.select(F.shiftright(part, inner).cast("int").alias("block"), F.pmod(part, F.lit(1 << inner)).cast("int").alias("bit")).distinct()
    out = np.zeros((1 << bits) >> 3, np.uint8)
    size = max((1 << inner) >> 3, 1)
    for row in found.groupBy("block").applyInArrow(_bits(bits), "block int, map binary").collect():  # 8192 rows of 1 KB at most
        out[row["block"] * size : (row["block"] + 1) * size] = np.frombuffer(row["map"], np.uint8)
    return out


def _hits(shared, bits: int, masks: list[int]):
    """The hashes of documents that both maps know, with the words around them."""

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        first, second = (np.unpackbits(m).view(bool) for m in shared.value)
        every = (*MASKS, *SHORT_MASKS)
        seeds = [m for m in masks if every[m]]
        whole = len(every) - 1 in masks
        shift, left = np.uint64(64 - bits), np.uint64(bits)
        for batch in batches:
            rows = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_hashes(text)
                n = len(words)
                for m, h in zip(seeds, seed_hashes(words, [every[m] for m in seeds]) if seeds else ()):
                    at = np.flatnonzero(first[(h >> shift).astype(np.int64)])
                    at = at[second[((h[at] << left) >> shift).astype(np.int64)]]
                    rows += [(node, m, x, p, _around(words, p), n) for p, x in zip(at.tolist(), h[at].view(np.int64).tolist())]
                if whole and 0 < n < FEW:
                    rows.append((node, len(every) - 1, int(whole_hash(words).view(np.int64)[0]), 0, _around(words, 0), n))
            for a in range(0, len(rows), 8192):
                kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 8192]), kinds)], ["node", "mask", "hash", "place", "words", "length"])

    return run


def leaked_windows(own, item, length: int, n: int, place: int, whole: bool) -> list[int]:
    """Starts, from the seed's place, of the leaked windows of a hit: words of document and item around it, the item's length."""
    import numpy as np

    if whole:
        return [0] if n == length and (own[BEFORE : BEFORE + n] == item[BEFORE : BEFORE + n]).all() else []
    if length < WINDOW:
        same = own[BEFORE : BEFORE + length] == item[BEFORE : BEFORE + length]
        return [0] if place + length <= n and same.sum() >= length - (length >= SOME) else []
    same = (own == item) & (item != 0)
    total = np.concatenate([[0], np.cumsum(same)])
    there = np.concatenate([[0], np.cumsum((own != 0) & (item != 0))])
    starts = np.arange(BEFORE + 1)
    good = (total[starts + WINDOW] - total[starts] >= WINDOW - SUBSTITUTIONS) & (there[starts + WINDOW] - there[starts] == WINDOW)
    return (starts[good] - BEFORE).tolist()


def _verify(batches: Iterator):
    """node, item, start and words of every leaked window."""
    import numpy as np
    import pyarrow as pa

    last = len(MASKS) + len(SHORT_MASKS) - 1
    for batch in batches:
        rows = []
        columns = [batch.column(n).to_pylist() for n in ("node", "mask", "place", "words", "length", "item_words", "item_length", "item")]
        for node, mask, place, words, n, item_words, length, item in zip(*columns):
            for s in leaked_windows(np.frombuffer(words, np.uint64), np.frombuffer(item_words, np.uint64), length, n, place, mask == last):
                rows.append((node, item, place + s, length))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.int64(), pa.int64(), pa.int32()))], ["node", "item", "start", "length"])


def leaked_texts(texts: DataFrame, benchmark: DataFrame, item: str = "item_id", item_text: str = "text") -> DataFrame:
    """node, items, longest for the texts (node, text) that hold a benchmark item, one row for each node.

    longest: words of the longest stretch in which every window is leaked.
    """
    spark = texts.sparkSession
    work = Scratch(spark, "leaks")
    items = benchmark.select(F.col(item).cast("long").alias("i"), text_or_empty(item_text).alias("t")).groupBy("t").agg(F.min("i").alias("i"))
    seeds = items.select("i", "t").repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(_seeds, SEED)
    # equal surroundings are verified once
    seeds = work.keep(seeds.groupBy("mask", "hash", "words", "length").agg(F.min("item").alias("item")), "seeds")
    found = {r["mask"]: r["n"] for r in seeds.groupBy("mask").agg(F.count("*").alias("n")).collect()}  # a row a mask
    bits = min(max(LEAST_BITS, math.ceil(math.log2(max(sum(found.values()), 1))) + SPARE_BITS), MOST_BITS)
    shared = spark.sparkContext.broadcast([bit_map(seeds, bits, after) for after in (0, bits)])  # 16 MB at most
    hits = work.keep(texts.select("node", "text").mapInArrow(_hits(shared, bits, sorted(found)), HIT).distinct(), "hits")

    # a hash with over 1 / HOT_SHARE of all hits is dealt out to SALTS parts; there are fewer than HOT_SHARE
    total = hits.count()
    hot = hits.groupBy("mask", "hash").agg(F.count("*").alias("n")).filter(F.col("n") > max(total // HOT_SHARE, SALTS)).select("mask", "hash", F.lit(True).alias("hot"))
    hot = F.broadcast(work.keep(hot, "hot"))
    mine = hits.join(hot, ["mask", "hash"], "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("node", "place"), F.lit(SALTS)).cast("int")).otherwise(0)).drop("hot")
    theirs = seeds.select("mask", "hash", F.col("words").alias("item_words"), F.col("length").alias("item_length"), "item").join(hot, ["mask", "hash"], "left")
    theirs = theirs.withColumn("salt", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))).drop("hot")
    windows = mine.join(theirs, ["mask", "hash", "salt"]).mapInArrow(_verify, "node binary, item long, start long, length int")
    windows = work.keep(windows.distinct(), "windows")

    starts = windows.groupBy("node", "start").agg(F.max("length").alias("length"))
    island = F.col("start") - F.row_number().over(Window.partitionBy("node").orderBy("start"))
    stretches = starts.withColumn("island", island).groupBy("node", "island").agg((F.max(F.col("start") + F.col("length")) - F.min("start")).alias("longest"))
    longest = stretches.groupBy("node").agg(F.max("longest").alias("longest"))
    listed = windows.groupBy("node").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = work.keep(listed.join(longest, "node"), "texts")
    work.drop("seeds", "hits", "hot", "windows")
    return out


def mark_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", names: tuple[str, str] = ("item_ids", "longest")) -> DataFrame:
    """df with two more columns of these names: ids of leaked items, and words of the longest leaked stretch (0 if none)."""
    spark = df.sparkSession
    node, = unused([*df.columns, *names], "__node")
    digest = F.unhex(F.sha2(text_or_empty(text).cast("binary"), 256))
    marked = leaked_texts(df.select(digest.alias("node"), text_or_empty(text).alias("text")), benchmark, item, item_text)
    marked = marked.select(F.col("node").alias(node), F.col("items").alias(names[0]), F.col("longest").alias(names[1]))
    rows, n = df.withColumn(node, digest), marked.count()
    if n <= BROADCAST_ROWS:
        out = rows.join(F.broadcast(marked), node, "left")
    else:  # rows of each marked text, so that copies of one do not meet in one task
        sizes = rows.select(node).join(marked, node, "left_semi").groupBy(node).agg(F.count("*").alias("__rows"))
        size, = unused([*rows.columns, *names], "__size")
        groups = marked.join(sizes, node).withColumnRenamed("__rows", size).withColumn(node, F.hex(node))
        rows = rows.withColumn(node, F.hex(node)).withColumn(size + "_", F.monotonically_increasing_id())
        out = attach_groups(rows, groups, node, size, df.count(), size + "_")
    return out.select(*quoted(df.columns), F.coalesce(names[0], F.array().cast("array<long>")).alias(names[0]), F.coalesce(names[1], F.lit(0)).cast("long").alias(names[1]))


def leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """doc_id, contaminated, item_ids and longest for every row of df."""
    marked = mark_leaks(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), benchmark, **options)
    return marked.select("doc_id", (F.col("longest") > 0).alias("contaminated"), "item_ids", "longest")


def decontaminate(df: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """df without the rows that hold a benchmark item."""
    names = tuple(unused(df.columns, "__items", "__longest"))
    return mark_leaks(df, benchmark, text, names=names, **options).filter(F.col(names[1]) == 0).select(*quoted(df.columns))
