"""Exact deduplication by Grace hashing.

Records are dealt by a content hash to buckets (shuffle files on disk). A bucket
whose distinct texts fit an open-addressing table is resolved by comparing
complete contents; a bucket that does not fit is written to a spill table in
the shared folder and dealt again, by another hash, to more buckets, until all
fit; a single text always does, so memory is bounded at any depth. Copies collapse inside the table, and each map task collapses its own
copies before the shuffle, so a group of any size adds one entry to its bucket.

Defined results: a null text counts as empty; a null id is below every other;
of rows with equal text and equal id one stays; an empty table gives an empty
result; further columns, whatever their names, travel with the row that stays.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import attach_groups, materialize, shuffle_partitions, text_or_empty

#: Bytes of distinct texts that one bucket's table may hold.
BUCKET_BYTES = 48 << 20
#: Bytes after which a map task hands its collapsed rows on.
COMBINE_BYTES = 24 << 20


class OpenAddressingTable:
    """Linear probing over a power-of-two slot array; entries hold the complete content."""

    def __init__(self, capacity: int = 1 << 10):
        self.clear(capacity)

    def clear(self, capacity: int = 1 << 10) -> None:
        self.slots = [-1] * capacity
        self.mask = capacity - 1
        self.hashes: list[int] = []
        self.texts: list[bytes] = []
        self.best: list = []
        self.counts: list[int] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.texts)

    def _grow(self) -> None:
        self.mask = 2 * (self.mask + 1) - 1
        self.slots = [-1] * (self.mask + 1)
        for entry, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = entry

    def add(self, h: int, text: bytes, best: tuple, count: int) -> None:
        """best: (order, id, was null, carried values); of equal texts the largest order stays."""
        at = h & self.mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.texts[entry] == text:
                self.counts[entry] += count
                if best[0] > self.best[entry][0]:
                    self.best[entry] = best
                return
            at = (at + 1) & self.mask
        self.slots[at] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        self.best.append(best)
        self.counts.append(count)
        self.bytes += len(text) + 200
        if 3 * len(self.texts) > 2 * self.mask:
            self._grow()


def _rows(batches, carried: list[str]):
    """(text, best, count) of every row of Arrow batches."""
    for batch in batches:
        cols = {n: batch.column(n).to_pylist() for n in batch.schema.names if n != "__bucket"}
        more = list(zip(*(cols[c] for c in carried))) if carried else [()] * batch.num_rows
        for text, null, i, n, rest in zip(cols["__text"], cols["__null"], cols["__id"], cols["__n"], more):
            yield text, (-(1 << 63) - 1 if i is None else i, i, null, rest), n


def _emit(table: OpenAddressingTable, schema, carried: list[str], level: int, resolved: bool, with_text: bool):
    import hashlib

    import pyarrow as pa
    import xxhash

    step = 4096
    for a in range(0, len(table), step):
        texts, best = table.texts[a : a + step], table.best[a : a + step]
        data = {
            "__bucket": [xxhash.xxh3_64_intdigest(t, seed=level) - (1 << 63) for t in texts],
            "__text": texts if with_text or not resolved else [None] * len(texts),
            "__null": [b[2] for b in best],
            "__id": [b[1] for b in best],
            "__n": table.counts[a : a + step],
        }
        if "__sha" in schema.names:
            data["__sha"] = [hashlib.sha256(t).hexdigest() if resolved else None for t in texts]
        for k, c in enumerate(carried):
            data[c] = [b[3][k] for b in best]
        yield pa.RecordBatch.from_arrays([pa.array(data[f.name], f.type) for f in schema], schema=schema)


def _combine(schema, carried: list[str], level: int, limit: int):
    """Collapses equal texts of a task, a bounded table at a time."""

    def run(batches: Iterator):
        import xxhash

        table = OpenAddressingTable()
        for text, best, n in _rows(batches, carried):
            table.add(xxhash.xxh3_64_intdigest(text, seed=101), text, best, n)
            if table.bytes > limit:
                yield from _emit(table, schema, carried, level, False, True)
                table.clear()
        yield from _emit(table, schema, carried, level, False, True)

    return run


def _resolve(schema, carried: list[str], level: int, limit: int, with_text: bool):
    """Resolves a bucket if its table stays under limit, else hands its rows on to the next level."""

    def run(batches: Iterator):
        import xxhash

        table, spilled = OpenAddressingTable(), False
        for text, best, n in _rows(batches, carried):
            table.add(xxhash.xxh3_64_intdigest(text, seed=101), text, best, n)
            if table.bytes > limit and len(table) > 1:
                spilled = True
                yield from _emit(table, schema, carried, level + 1, False, True)
                table.clear()
        yield from _emit(table, schema, carried, level + 1, not spilled, with_text)

    return run


def _arrow(schema: T.StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def grace_dedup(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    carry: list[str] | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    combine_bytes: int = COMBINE_BYTES,
    total_bytes: int | None = None,
) -> DataFrame:
    """One row per distinct text: __id (largest), __n (rows), __sha, and the carried columns of the row that stays.

    With carry, the text itself comes back as __text (null where the row that stays had none).
    """
    spark = df.sparkSession
    fields = {f.name: f.dataType for f in df.schema.fields}
    carried = [f"__c{k}" for k in range(len(carry or []))]
    with_text = carry is not None
    base = [
        T.StructField("__bucket", T.LongType()),
        T.StructField("__text", T.BinaryType()),
        T.StructField("__null", T.BooleanType()),
        T.StructField("__id", T.LongType()),
        T.StructField("__n", T.LongType()),
        *[T.StructField(c, fields[name]) for c, name in zip(carried, carry or [])],
    ]
    moving = T.StructType(base)
    leaf = T.StructType([*base, T.StructField("__sha", T.StringType())])
    if total_bytes is None:
        total_bytes = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = df.select(
        text_or_empty(text).cast("binary").alias("__text"),
        F.col(text).isNull().alias("__null"),
        F.col(key).cast("long").alias("__id"),
        F.lit(1).cast("long").alias("__n"),
        *[F.col(name).alias(c) for c, name in zip(carried, carry or [])],
    ).mapInArrow(_combine(_arrow(moving), carried, 0, combine_bytes), moving)
    done, level, before = None, 0, None
    while True:
        buckets = shuffle_partitions(spark, total_bytes, bucket_bytes // 2)
        out = rows.repartition(buckets, "__bucket").mapInArrow(_resolve(_arrow(leaf), carried, level, bucket_bytes, with_text), leaf)
        out = materialize(out, f"grace-{level}")
        if before is not None:
            # the rows that this level dealt again are still needed only for the results resolved there
            done = done.unionByName(out.filter("__sha is not null"))
        else:
            done = out.filter("__sha is not null")
        left = out.filter("__sha is null")
        # one small aggregate decides whether any bucket spilled
        rest = left.agg(F.sum(F.octet_length("__text")), F.count("*")).first()
        if not rest[1]:
            return done.select("__id", "__n", "__sha", "__null", *(["__text"] if with_text else []), *carried)
        before, rows, total_bytes, level = out, left.select([f.name for f in base]), 4 * (rest[0] or 0), level + 1


def exact_dedup(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """df without the copies; of equal texts the row with the largest key stays, with all its columns.

    Null texts count as empty ones. Ties in the key keep one row.
    """
    carry = [c for c in df.columns if c != text]
    kept = grace_dedup(df, text, key, carry, **options)
    back = {c: F.col(f"__c{k}") for k, c in enumerate(carry)}
    back[text] = F.when(~F.col("__null"), F.col("__text").cast("string"))
    return kept.select(*[back[c].alias(c) for c in df.columns])


def duplicate_groups(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row per row of df: doc_id, keep_id, group_size, kept, text_sha256.

    Groups are made by comparing contents; a row finds its group by SHA-256. Rows that repeat the kept id with the same text all count as kept.
    """
    df = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    size = df.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    groups = grace_dedup(df, total_bytes=size[1] or 0, **options).select(F.col("__sha").alias("text_sha256"), F.col("__id").alias("keep_id"), F.col("__n").alias("group_size"))
    members = df.select("doc_id", F.sha2(text_or_empty("text"), 256).alias("text_sha256"))
    out = attach_groups(members, groups, "text_sha256", "group_size", size[0], "doc_id")
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
