"""WARC archives and their capture index, merged from sorted runs by loser trees.

Every task writes its pages to one archive (a gzip member a record) and sorts
the index entries of its own captures, some at a time: a run. The key space
(reversed-host URL key, timestamp, page id) is cut at splitters taken from a
bounded sample of keys, which decides only how even the ranges are; a key that
the sample holds many times gets several ranges. Runs are written as short
sorted blocks. Each range takes its blocks in the order of their first entries
(Spark's sort, which spills) and merges them with a loser tree that blocks join
when their turn comes, so that about one block of each run is in memory.
Ranges in order make one globally ordered capture history.

An archive's name is new for every attempt of a task, and only the names that
Spark commits with the runs are referred to; what lost attempts left is removed.

Defined results: a null payload counts as empty; of equal payloads of at least
`least_bytes` bytes the one with the largest page id is the response and the
others revisit it (rows that repeat that id are responses too; a null id is
below every other and one second before the first); a null URL is written as
urn:null; an empty table gives empty archives, index and result.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import itertools
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, WholeFile, attach_groups, discard, filesystem, materialize, scratch, shuffle_partitions, text_or_empty

#: Entries that one sorted run holds in memory, and those of one of its blocks.
RUN_ENTRIES, BLOCK_ENTRIES = 200_000, 512
#: Bytes of index entries for each range, an entry's size on average, and ranges at most (a merge of any length streams).
RANGE_BYTES, ENTRY_BYTES, MOST_RANGES = 32 << 20, 200, 8192
#: Keys sampled for each range.
KEYS_A_RANGE = 16
GZIP_LEVEL = 3
START, SECONDS = datetime.datetime(2024, 1, 1), 240_000_000_000
ENTRY = "key string, ts string, page_id long, file string, offset long, length long"
NO_ID = -(1 << 63)


def url_key(url: str | None) -> str:
    """The URL with its host reversed, in lower case, without scheme, www and fragment."""
    if url is None:
        return "urn:null"
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
        port = f":{parts.port}" if parts.port and parts.port not in (80, 443) else ""
    except ValueError:
        return url.strip().lower()
    if not host:
        return url.strip().lower()
    return ",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/").lower() + (f"?{parts.query.lower()}" if parts.query else "")


def timestamp(page_id: int | None) -> str:
    """Fourteen digits; pages carry no time of capture, so the id counts seconds from START, round again after SECONDS."""
    return (START + datetime.timedelta(seconds=-1 if page_id is None else page_id % SECONDS)).strftime("%Y%m%d%H%M%S")


class LoserTree:
    """Merges sorted iterators, which may join at any time.

    A node keeps the loser of its match; it also remembers the winner, so that a
    leaf that is not the overall winner can be filled again by replaying its path.
    """

    def __init__(self, sources=()):
        self._resize(1)
        for s in sources:
            self.add(s)

    def _resize(self, k: int) -> None:
        """k leaves; the sources so far keep the first ones."""
        old = getattr(self, "k", 0)
        self.heads = (self.heads if old else []) + [None] * (k - old)
        self.sources = (self.sources if old else []) + [iter(())] * (k - old)
        self.free = [*range(k - 1, old - 1, -1), *getattr(self, "free", [])]
        self.k, self.winner, self.loser = k, [0] * k + list(range(k)), [0] * k
        for node in range(k - 1, 0, -1):
            self._match(node)

    def _match(self, node: int) -> None:
        a, b = self.winner[2 * node], self.winner[2 * node + 1]
        x, y = self.heads[a], self.heads[b]
        if x is None or y is not None and y < x:
            a, b = b, a
        self.winner[node], self.loser[node] = a, b

    def _replay(self, leaf: int) -> None:
        node = (leaf + self.k) // 2
        while node:
            self._match(node)
            node //= 2

    def add(self, source) -> None:
        source = iter(source)
        if (head := next(source, None)) is None:
            return
        if not self.free:
            self._resize(2 * self.k)
        leaf = self.free.pop()
        self.heads[leaf], self.sources[leaf] = head, source
        self._replay(leaf)

    def least(self):
        """The smallest entry, or None."""
        return self.heads[self.winner[1] if self.k > 1 else 0]

    def take(self):
        leaf = self.winner[1] if self.k > 1 else 0
        out = self.heads[leaf]
        self.heads[leaf] = next(self.sources[leaf], None)
        if self.heads[leaf] is None:
            self.free.append(leaf)
        self._replay(leaf)
        return out

    def __iter__(self):
        while self.least() is not None:
            yield self.take()


def merged(blocks: Iterator[list]) -> Iterator:
    """The entries of sorted blocks, which come in the order of their first entries, in order."""
    tree = LoserTree()
    for block in blocks:
        while (head := tree.least()) is not None and head < block[0]:
            yield tree.take()
        tree.add(block)
    yield from tree


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, size: int) -> bytes:
    """One WARC record, uncompressed."""
    stamp = timestamp(page_id)
    date = f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:]}Z"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Target-URI: {'urn:null' if url is None else quote(url, safe=''.join(map(chr, range(33, 127))))}",
        f"WARC-Date: {date}",
        f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'null' if refers_to is None else refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What one record says, its payload checked against length and digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))[16:])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    if lines[0] != "WARC/1.1" or len(block) != int(fields["Content-Length"]):
        raise ValueError("not a whole WARC record")
    if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its header")

    def page(name: str) -> int | None:
        value = fields.get(name, "<urn:page:null>")[10:-1]
        return None if value == "null" else int(value)

    return {"page_id": page("WARC-Record-ID"), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": page("WARC-Refers-To"), "url": fields["WARC-Target-URI"], "payload": payload}


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def ranges_of(entries: list, splitters: list, run: str) -> list[int]:
    """The range of each entry; runs take turns in the ranges of a key that is a splitter several times."""
    out, last, at = [], None, 0
    for e in entries:
        if e[:3] != last:
            last = e[:3]
            a, at = bisect_left(splitters, last), bisect_right(splitters, last)
            if at - a > 1:
                at = a + 1 + zlib.crc32(run.encode()) % (at - a)
        out.append(at)
    return out


NAMES = ("key", "ts", "page_id", "file", "offset", "length")


def _kinds() -> tuple:
    import pyarrow as pa

    return pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()


def _write(folder: str, splitters: list, least_bytes: int, run_entries: int, block_entries: int):
    """Writes a task's archive; yields the blocks of its sorted runs."""

    def run(batches: Iterator):
        import pyarrow as pa

        uri, entries, archive = f"{folder}/{uuid.uuid4().hex}.warc.gz", [], None

        def sorted_run():
            entries.sort()
            cuts = ranges_of(entries, splitters, f"{uri}#{archive.size}")
            a = 0
            while a < len(entries):
                rows = []
                while a < len(entries) and len(rows) < 64:
                    b = min(bisect_right(cuts, cuts[a]), a + block_entries)
                    rows.append((cuts[a], *entries[a][:3], *map(list, zip(*entries[a:b]))))
                    a = b
                kinds = (pa.int32(), *_kinds()[:3], *map(pa.list_, _kinds()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["range", "first_key", "first_ts", "first_id", *NAMES])
            entries.clear()

        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "latest", "copies")]
            for page_id, url, payload, latest, copies in zip(*columns):
                archive = archive or WholeFile(uri)
                latest = None if latest == NO_ID else latest
                revisit = copies is not None and len(payload) >= least_bytes and page_id != latest
                packed = _gzip(record(page_id, url, payload, base32_sha1(payload), latest, revisit, len(payload)))
                entries.append((url_key(url), timestamp(page_id), NO_ID if page_id is None else page_id, uri, archive.size, len(packed)))
                archive.write(packed)
                if len(entries) >= run_entries:
                    yield from sorted_run()
        if archive:
            yield from sorted_run()
            archive.close()

    return run


def _gzip(data: bytes) -> bytes:
    pack = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _merge(batches: Iterator):
    """Ranges one after the other: their blocks, in order of first entries, through a loser tree."""
    import pyarrow as pa

    def blocks():
        for batch in batches:
            columns = [batch.column(n) for n in NAMES]
            for k, at in enumerate(batch.column("range").to_pylist()):
                yield at, list(zip(*[c[k].as_py() for c in columns]))

    def out(rows):
        kinds = (pa.int32(), pa.int64(), *_kinds())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["range", "place", *NAMES])

    rows: list[tuple] = []
    for at, group in itertools.groupby(blocks(), key=lambda x: x[0]):
        for place, entry in enumerate(merged(block for _, block in group)):
            rows.append((at, place, *entry))
            if len(rows) == 8192:
                yield out(rows)
                rows = []
    if rows:
        yield out(rows)


def splitters_of(pages: DataFrame, ranges: int, page_id: str, url: str) -> list[tuple]:
    """ranges - 1 keys that cut a sample of ranges * KEYS_A_RANGE keys evenly."""
    if ranges < 2:
        return []
    sample = pages.select(F.col(page_id).cast("long").alias("p"), F.col(url).alias("u")).orderBy(F.xxhash64("p", "u"), "p").limit(ranges * KEYS_A_RANGE).collect()
    keys = sorted((url_key(r["u"]), timestamp(r["p"]), NO_ID if r["p"] is None else r["p"]) for r in sample)
    return [keys[len(keys) * k // ranges] for k in range(1, ranges)] if keys else []


def write_archives(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0, folder: str | None = None, run_entries: int = RUN_ENTRIES, block_entries: int = BLOCK_ENTRIES, ranges: int | None = None
) -> DataFrame:
    """Writes the archives and returns the merged index: range, place, and the columns of ENTRY; (range, place) is the global order."""
    spark = pages.sparkSession
    work, folder = Scratch(spark, "warc"), folder or scratch(spark, "archives")
    total = pages.count()
    content = text_or_empty(html).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), content.alias("payload"), F.sha1(content).alias("digest"))
    groups = rows.groupBy("digest").agg(F.max(F.coalesce("page_id", F.lit(NO_ID))).alias("latest"), F.count("*").alias("copies")).filter("copies > 1")
    rows = attach_groups(rows, groups, "digest", "copies", total, "page_id")
    ranges = ranges or min(shuffle_partitions(spark, total * ENTRY_BYTES, RANGE_BYTES), MOST_RANGES)
    cut = splitters_of(pages, ranges, page_id, url)
    schema = "range int, first_key string, first_ts string, first_id long, key array<string>, ts array<string>, page_id array<long>, file array<string>, offset array<long>, length array<long>"
    runs = work.keep(rows.mapInArrow(_write(folder, cut, least_bytes, run_entries, block_entries), schema), "runs")
    ordered = runs.repartition(max(ranges, 1), "range").sortWithinPartitions("range", "first_key", "first_ts", "first_id")
    index = materialize(ordered.mapInArrow(_merge, f"range int, place long, {ENTRY}"), "warc-index")
    work.drop("runs")
    sweep(index, folder)
    return index


def sweep(index: DataFrame, folder: str) -> int:
    """Deletes files of the folder that the index does not name, which lost attempts of tasks have left; returns how many."""
    spark = index.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    there = [str(f.getPath().getName()) for f in fs.listStatus(at)] if fs.exists(at) else []
    named = index.select(F.element_at(F.split("file", "/"), -1).alias("name")).distinct()
    if len(there) == named.count():
        return 0
    gone = spark.createDataFrame([(n,) for n in there], "name string").join(named, "name", "left_anti").collect()
    for row in gone:  # as many as attempts were lost
        discard(spark, f"{folder}/{row['name']}")
    return len(gone)


def _read(batches: Iterator):
    import pyarrow as pa

    source, opened = None, None
    for batch in batches:
        rows = []
        for file, offset, length, position, key, ts in zip(*[batch.column(n).to_pylist() for n in ("file", "offset", "length", "position", "key", "ts")]):
            if file != opened:
                if source is not None:
                    source.close()
                fs, path = filesystem(file)
                source, opened = fs.open_input_file(path), file
            got = parse(zlib.decompress(source.read_at(length, offset), 31))
            rows.append((got["page_id"], got["payload_bytes"], got["payload_digest"], got["record_type"], got["refers_to"], key, ts, position))
        columns = list(zip(*rows)) or [()] * 8
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], list(names))
    if source is not None:
        source.close()


def read_archives(index: DataFrame) -> DataFrame:
    """Every capture of the index, read from its archive, with its position in the global order."""
    spark = index.sparkSession
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = index.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = index.join(F.broadcast(starts), "range").withColumn("position", F.col("start") + F.col("place"))
    files = placed.repartition(shuffle_partitions(spark), "file").sortWithinPartitions("file", "offset")
    return files.mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured string, position long")


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, and the capture's place in the merged index."""
    return read_archives(write_archives(pages, **options))
