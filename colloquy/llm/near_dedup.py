"""Near-duplicate classes by DartMinHash.

A document is a weighted set: its shingles of five words (lower case, runs of
letters, digits and underscores) with their counts. Darts arrive on the plane
(weight, rank) of every shingle as a Poisson process that only the shingle's
hash decides; a dart hits if it lands below the shingle's weight. Every dart
names a coordinate of the signature, and the earliest hit of each coordinate is
kept, so two signatures agree in a coordinate with probability equal to the
weighted Jaccard similarity (sum of minima over sum of maxima of the counts).
About K ln K + 2K darts a document are thrown however long it is.

Signatures are cut into bands. Documents that share a band are compared with
one leader of their bucket, then with the best-linked member, then, where a
bucket still holds several classes, across classes in blocks: the signatures say
which members have a partner worth a comparison, and only their shingle sets are
sent, best estimates first. Every link counts only after the exact similarity is
computed from the whole sets. A leader's set is sent once for each block of its
members. Classes are the connected components of links of 0.8 or more.

Defined results: documents with the same words are one node, so copies never
multiply pairs; a document of fewer than five words has one shingle of all its
words; one without words (null, empty, only marks) equals only identical texts,
null counting as empty; null and repeated ids are allowed (a null id is below
every other); of a class, near_dedup() keeps one row, that of the smallest id
and, among rows that repeat it, of the smallest hash; an empty table gives an
empty result; columns of any name pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, attach_groups, components, quoted, text_or_empty, unused

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
#: Coordinates of a signature; the first BANDS * ROWS make the bands, all of them the estimate.
K = 240
#: Standard deviations below the threshold at which an estimate excludes a pair.
MARGIN = 4.0
#: Rows of a bucket that are compared in memory at once, on either side.
BLOCK_ROWS = 1_000
#: Below so many elements, darts of an element are thrown together.
FEW = 3_000
WORD = re.compile(r"\w+")
NO_ID = -(1 << 63)


def mix(x):
    """splitmix64's finaliser on an array of unsigned 64-bit integers."""
    import numpy as np

    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """64-bit hashes of words, kept while the table stays small."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = WordHashes()


def word_hashes(text: str):
    import numpy as np

    words = WORD.findall(text.lower())
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def weighted_shingles(words, size: int = SHINGLE):
    """Distinct shingle hashes in order, and their counts."""
    import numpy as np

    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    size = min(size, len(words))
    with np.errstate(over="ignore"):
        h = np.full(len(words) - size + 1, size, np.uint64)
        for k in range(size):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + words[k : len(words) - size + 1 + k])
    return np.unique(h, return_counts=True)


def dart_signature(elements, weights, k: int = K):
    """The identity of the earliest dart in each of k coordinates; elements must not be empty, weights are above 0."""
    import numpy as np

    x = np.asarray(weights, float)
    # regions of weight: [0, 1), [1, 2), [2, 4), ...; an element throws into those that begin below its weight
    keys, low, width, top = [], [], [], []
    nu, start = 0, 0.0
    with np.errstate(over="ignore"):
        while (into := x > start).any():
            size = 1.0 if nu == 0 else start
            keys.append(mix(elements[into] + np.uint64((nu + 1) * 0xD1342543DE82EF95 % (1 << 64))))
            n = len(keys[-1])
            low.append(np.full(n, start))
            width.append(np.full(n, size))
            top.append(x[into])
            nu, start = nu + 1, start + size
        keys, low, width, top = map(np.concatenate, (keys, low, width, top))
        limit = (k * math.log(k) + 2 * k) / x.sum()
        while True:
            found = _throw(keys, low, width, top, limit, k)
            if (found[1] != 0).all():
                return found[0]
            limit *= 2


def _throw(keys, low, width, top, limit, k):
    """The darts of rank up to limit, earliest of each coordinate: (identities, hit marks)."""
    import numpy as np

    ranks, at, ids = [], [], []
    base, j = np.zeros(len(keys)), 0
    while len(keys):
        # many elements take one dart each; few take as many as they may need at once
        ahead = 1 if len(keys) >= FEW else min(max(1, math.ceil(limit * width.max() * 1.1)), 4096)
        steps = np.arange(j + 1, j + ahead + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        dart = mix((keys[:, None] + steps[None, :]).ravel())
        gap = np.log(((dart >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
        if ahead == 1:
            rank = base - gap / width
            own = np.flatnonzero(rank <= limit)
            last = rank
        else:
            gap = -gap.reshape(-1, ahead) / width[:, None]
            gap[:, 0] += base
            rank = np.cumsum(gap, axis=1)  # one addition after another, as with single darts
            last = rank[:, -1]
            rank = rank.ravel()
            own = np.flatnonzero(rank <= limit)
        rank, dart, whose = rank[own], dart[own], own // ahead
        other = mix(dart ^ np.uint64(0xA0761D6478BD642F))
        hit = low[whose] + width[whose] * ((other >> np.uint64(11)).astype(float) * 2.0**-53) < top[whose]
        ranks.append(rank[hit])
        ids.append(dart[hit])
        at.append((mix(other[hit]) % np.uint64(k)).astype(np.int64))
        going = np.flatnonzero(last <= limit)
        keys, base, low, width, top, j = keys[going], last[going], low[going], width[going], top[going], j + ahead
    ranks, ids, at = map(np.concatenate, (ranks, ids, at))
    order = np.argsort(-ranks, kind="stable")
    out, marks = np.zeros(k, np.uint64), np.zeros(k, np.int8)
    out[at[order]] = ids[order]  # the last written, that is the earliest, stays
    marks[at] = 1
    return out, marks


def band_keys(signature, bands: int, rows: int):
    import numpy as np

    with np.errstate(over="ignore"):
        parts = signature[: bands * rows].reshape(bands, rows)
        h = np.arange(1, bands + 1, dtype=np.uint64)
        for r in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, r])
    return h.view(np.int64)


def weighted_jaccard(a, wa, b, wb) -> float:
    import numpy as np

    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = int(np.minimum(wa[i], wb[j]).sum())
    return shared / (int(wa.sum()) + int(wb.sum()) - shared) if shared else 0.0


def node_of(text: str, words) -> str:
    """Documents of the same words are one node."""
    import xxhash

    return xxhash.xxh3_128_hexdigest(words.tobytes()) if len(words) else "-" + xxhash.xxh3_128_hexdigest(text)


def _signatures(k: int, bands: int, rows: int):
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            nodes, keys, sketches, sizes = [], [], [], []
            for text in batch.column("text").to_pylist():
                words = word_hashes(text)
                nodes.append(node_of(text, words))
                sizes.append(max(len(words) - SHINGLE + 1, 1))
                if len(words):
                    signature = dart_signature(*weighted_shingles(words), k)
                    keys.append(band_keys(signature, bands, rows))
                    sketches.append((signature >> np.uint64(48)).astype("<u2").tobytes())
                else:
                    keys.append([])
                    sketches.append(b"")
            made = [pa.array(nodes), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), *made], ["doc_id", "key", "node", "bands", "sketch", "shingles"])
        _HASHES.clear()  # the worker has other things to hold

    return run


def _sets(batches: Iterator):
    """node, elements and counts of whole texts."""
    import pyarrow as pa

    for batch in batches:
        rows = []
        for text in batch.column(0).to_pylist():
            words = word_hashes(text)
            elements, counts = weighted_shingles(words)
            rows.append((node_of(text, words), elements.tobytes(), counts.astype("<i4").tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["node", "elements", "counts"])
    _HASHES.clear()


def _similarities(batches: Iterator):
    """Rows in order of hub and block, the hub's own first: the similarity of every member with its hub."""
    import numpy as np
    import pyarrow as pa

    hub, elements, counts = None, None, None
    for batch in batches:
        rows = []
        for h, node, e, c in zip(*[batch.column(n).to_pylist() for n in ("hub", "member", "e", "c")]):
            e, c = np.frombuffer(e, "<u8"), np.frombuffer(c, "<i4")
            if node is None:
                hub, elements, counts = h, e, c
            elif h != hub:
                raise RuntimeError(f"the set of {h} is missing")
            else:
                rows.append((min(h, node), max(h, node), weighted_jaccard(elements, counts, e, c)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.string(), pa.float64()))], ["a", "b", "sim"])


class Block:
    """Members of a bucket on two sides (0 and 1, or both: 2), and which pairs across classes are worth a comparison."""

    def __init__(self, group, threshold: float, least: float):
        import numpy as np

        self.nodes = group.column("node").to_pylist()
        _, self.kind = np.unique(np.array(group.column("root").to_pylist()), return_inverse=True)
        self.sides, bucket = np.array(group.column("side").to_pylist()), group.column("bucket")[0].as_py()
        self.sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), "<u2").reshape(len(self.nodes), -1)
        self.bands = np.array(group.column("bands").to_pylist(), np.int64)
        self.own = (self.bands == bucket).argmax(axis=1)
        self.size = np.array(group.column("shingles").to_pylist())
        self.threshold, self.least = threshold, least
        self.left, self.right = np.flatnonzero((self.sides == 0) | (self.sides == 2)), np.flatnonzero((self.sides == 1) | (self.sides == 2))

    def partners(self, i: int):
        """Members of other classes, best estimate first, that do not share an earlier bucket with member i."""
        import numpy as np

        js = self.right[self.kind[self.right] != self.kind[i]]
        js = js[js > i] if self.sides[i] == 2 else js
        js = js[np.minimum(self.size[js], self.size[i]) >= self.threshold * np.maximum(self.size[js], self.size[i])]
        js = js[~(self.bands[js, : self.own[i]] == self.bands[i, : self.own[i]]).any(axis=1)]
        estimate = (self.sketch[js] == self.sketch[i]).mean(axis=1)
        return js[np.argsort(-estimate, kind="stable")][: int((estimate >= self.least).sum())]


def _worthwhile(threshold: float, least: float):
    """The members of a block that have a partner."""

    def run(group):
        import numpy as np

        block = Block(group, threshold, least)
        wanted = np.zeros(len(block.nodes), bool)
        for i in block.left:
            js = block.partners(i)
            wanted[js] = True
            wanted[i] |= len(js) > 0
        return group.filter(wanted)

    return run


def _across(threshold: float, least: float):
    """Links between different classes of one block, as many as join classes and no more; the exact similarity decides."""

    def run(group):
        import numpy as np
        import pyarrow as pa

        block = Block(group, threshold, least)
        nodes, kind = block.nodes, block.kind
        elements = [np.frombuffer(x, "<u8") for x in group.column("e").to_pylist()]
        counts = [np.frombuffer(x, "<i4") for x in group.column("c").to_pylist()]
        a, b = [], []
        for i in block.left:
            for j in block.partners(i):
                if kind[i] != kind[j] and weighted_jaccard(elements[i], counts[i], elements[j], counts[j]) >= threshold:
                    a.append(min(nodes[i], nodes[j]))
                    b.append(max(nodes[i], nodes[j]))
                    kind[kind == kind[j]] = kind[i]
        return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()), "sim": pa.array([1.0] * len(a), pa.float64())})

    return run


def row_key(key: str, text: str):
    """What rows of equal id and text have in common."""
    return F.sha2(F.concat(F.coalesce(F.col(key).cast("long").cast("string"), F.lit("")), F.lit(":"), text_or_empty(text)).cast("binary"), 256)


def _classified(df: DataFrame, text: str, key: str, threshold: float, k: int, bands: int, rows: int, block_rows: int, margin: float | None) -> DataFrame:
    """doc_id, key, rows (of its node), class_rep (id and key of the row that stays), class_size for every row of df."""
    spark = df.sparkSession
    work = Scratch(spark, "near")
    docs = df.select(F.col(key).cast("long").alias("doc_id"), row_key(key, text).alias("key"), text_or_empty(text).alias("text"))
    signed = docs.mapInArrow(_signatures(k, bands, rows), "doc_id long, key string, node string, bands array<long>, sketch binary, shingles long")
    signed = work.keep(signed, "signed")
    rank = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "key")
    nodes = signed.groupBy("node").agg(F.min(rank).alias("rep"), F.count("*").alias("rows"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("shingles").alias("shingles"))
    nodes = work.keep(nodes, "nodes")

    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("leader")).filter("n > 1")
    shared = work.keep(entries.join(buckets, "bucket"), "shared")
    involved = shared.select("node").distinct().join(nodes.select("node", "rep.key"), "node").select("key")
    sets = docs.join(involved, "key", "left_semi").select("text").mapInArrow(_sets, "node string, elements binary, counts binary")
    sets = work.keep(sets.groupBy("node").agg(F.first("elements").alias("e"), F.first("counts").alias("c")), "sets")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        """Exact similarities, by column sim, of pairs (hub, member); a hub's set goes once to each block of its members."""
        pairs = work.keep(pairs, f"pairs-{name}")
        hubs = pairs.groupBy("hub").agg(F.count("*").alias("n"))
        pairs = attach_groups(pairs, hubs, "hub", "n", pairs.count(), "member")
        pairs = pairs.withColumn("block", F.pmod(F.xxhash64("member"), F.ceil(F.col("n") / F.lit(block_rows))).cast("int"))
        own = sets.select(F.col("node").alias("__n"), "e", "c")
        members = pairs.join(own, F.col("member") == F.col("__n")).select("hub", "block", "member", "e", "c")
        leaders = pairs.select("hub", "block").distinct().join(own, F.col("hub") == F.col("__n")).select("hub", "block", F.lit(None).cast("string").alias("member"), "e", "c")
        both = members.unionByName(leaders).repartition("hub", "block").sortWithinPartitions("hub", "block", F.col("member").asc_nulls_first())
        out = work.keep(both.mapInArrow(_similarities, "a string, b string, sim double"), name)
        work.drop(f"pairs-{name}")
        return out

    def star(members: DataFrame, leader: str) -> DataFrame:
        return members.filter(F.col("node") != F.col(leader)).select(F.col(leader).alias("hub"), F.col("node").alias("member")).distinct()

    def rooted(edges: DataFrame, name: str) -> DataFrame:
        found = components(edges.filter(F.col("sim") >= threshold).select("a", "b"), Scratch(spark, f"near-{name}"))
        return found.withColumnRenamed("node", "__n")

    def unsettled(roots: DataFrame) -> DataFrame:
        """Members, with their root, of the buckets that hold several classes."""
        labelled = shared.join(roots, F.col("node") == F.col("__n"), "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
        several = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n")).filter("x <> y")
        return labelled.join(several.select("bucket", "n"), "bucket")

    # 1. every member of a bucket against the bucket's first node
    tested = links(star(shared, "leader"), "tested-1")
    roots = rooted(tested, "roots-1")
    # 2. against the member with the most links so far: the centre of a family of copies
    degree = tested.filter(F.col("sim") >= threshold).select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    open_ = work.keep(unsettled(roots).join(degree, "node", "left").fillna(0, ["links"]), "open-2")
    centre = open_.groupBy("bucket").agg(F.max(F.struct("links", "node", "root")).alias("top"))
    again = open_.join(centre, "bucket").filter(F.col("root") != F.col("top.root")).withColumn("centre", F.col("top.node"))
    done = tested.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select(F.col("p.a").alias("hub"), F.col("p.b").alias("member"))
    again = star(again, "centre").join(done, ["hub", "member"], "left_anti")
    tested = tested.unionByName(links(again, "tested-2"))
    roots = rooted(tested, "roots-2")
    # 3. what is still apart. Of a bucket, members of its largest class meet the others only, and those meet each other, too,
    # all in pairs of blocks
    left = work.keep(unsettled(roots), "open-3")
    by_class = left.groupBy("bucket", "root").agg(F.count("*").alias("m"))
    largest = by_class.groupBy("bucket").agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("all"))
    left = left.drop("n").join(largest, "bucket")
    number = lambda n: F.ceil(n / F.lit(block_rows)).cast("int")
    most, rest = number(F.col("top.m")), F.greatest(number(F.col("all") - F.col("top.m")), F.lit(1))
    mine = lambda blocks: F.pmod(F.xxhash64("node"), blocks).cast("int")
    place = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))
    in_largest = F.transform(F.sequence(F.lit(0), rest - 1), lambda o: place(-1 - o, mine(most), F.lit(1)))
    to_largest = F.transform(F.sequence(F.lit(0), most - 1), lambda o: place(-1 - mine(rest), o, F.lit(0)))
    among = F.transform(F.sequence(F.lit(0), rest - 1), lambda o: place(F.least(o, mine(rest)), F.greatest(o, mine(rest)), F.when(o == mine(rest), 2).when(mine(rest) < o, 0).otherwise(1)))
    to = F.when(F.col("root") == F.col("top.root"), in_largest).otherwise(F.concat(to_largest, among))
    dealt = left.select("bucket", F.explode(to).alias("to"), "node", "root").select("bucket", "to.i", "to.j", "to.side", "node", "root")
    dealt = dealt.join(nodes.select("node", "sketch", "bands", "shingles"), "node")
    least = -1.0 if margin is None else threshold - margin * math.sqrt(threshold * (1 - threshold) / k)
    columns = "node string, bucket long, i int, j int, side int, root string, sketch binary, bands array<long>, shingles long"
    worth = work.keep(dealt.groupBy("bucket", "i", "j").applyInArrow(_worthwhile(threshold, least), columns), "worth-3")
    across = worth.join(sets, "node").groupBy("bucket", "i", "j").applyInArrow(_across(threshold, least), "a string, b string, sim double")
    tested = tested.unionByName(work.keep(across, "tested-3"))
    roots = work.keep(rooted(tested, "roots-3"), "roots")

    joined = nodes.select("node", "rep", "rows").join(roots, F.col("node") == F.col("__n"), "left").withColumn("root", F.coalesce("root", "node"))
    classes = joined.groupBy("root").agg(F.min("rep").alias("class_rep"), F.sum("rows").alias("class_size"))
    by_node = work.keep(joined.join(classes, "root").select("node", "rows", "class_rep", "class_size"), "classes")
    work.drop("nodes", "shared", "sets", "tested-1", "tested-2", "tested-3", "open-2", "open-3", "worth-3", "roots")
    return attach_groups(signed.select("doc_id", "key", "node"), by_node, "node", "rows", signed.count(), "key")


def near_classes(
    df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, k: int = K, bands: int = BANDS, rows: int = ROWS, block_rows: int = BLOCK_ROWS, margin: float | None = MARGIN
) -> DataFrame:
    """One row per row of df: doc_id, class_id (smallest id of its class), class_size (rows), kept (it has that id).

    margin: None compares every pair of a bucket, whatever its estimate.
    """
    out = _classified(df, text, key, threshold, k, bands, rows, block_rows, margin)
    class_id = F.when(F.col("class_rep.id") != NO_ID, F.col("class_rep.id"))
    return out.select("doc_id", class_id.alias("class_id"), "class_size", F.col("doc_id").eqNullSafe(class_id).alias("kept"))


def near_dedup(
    df: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD, k: int = K, bands: int = BANDS, rows: int = ROWS, block_rows: int = BLOCK_ROWS, margin: float | None = MARGIN
) -> DataFrame:
    """One row of each class of df, that of the smallest id; columns as in df."""
    own, rep, size, place = unused(df.columns, "__row_key", "__class_rep", "__copies", "__place")
    classified = _classified(df, text, key, threshold, k, bands, rows, block_rows, margin)
    by_key = classified.groupBy("key").agg(F.first("class_rep.key").alias(rep), F.count("*").alias(size))
    by_key = Scratch(df.sparkSession, "near").keep(by_key.withColumnRenamed("key", own), "rows")
    total = by_key.agg(F.sum(size)).first()[0] or 0
    keyed = df.withColumns({own: row_key(key, text), place: F.monotonically_increasing_id()})
    kept = attach_groups(keyed, by_key, own, size, total, place).filter(F.col(own) == F.col(rep))
    once = kept.filter(F.col(size) == 1).select(*quoted(df.columns))
    if not by_key.filter((F.col(own) == F.col(rep)) & (F.col(size) > 1)).limit(1).count():
        return once
    # rows that repeat id and text: one of them, added up before it is sent
    whole = F.struct(F.xxhash64(*quoted(df.columns)).alias("h"), F.struct(*quoted(df.columns)).alias("row"))
    one = kept.filter(F.col(size) > 1).select(own, whole.alias("w")).groupBy(own).agg(F.min_by("w.row", "w.h").alias("row"))
    return once.unionByName(one.select(*[F.col("row")[c].alias(c) for c in df.columns]))
