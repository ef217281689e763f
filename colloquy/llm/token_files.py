"""Token-id files: fixed-size id blocks, transposed to bit or byte planes, each plane compressed with zstandard.

File layout (little-endian): magic, plane frames of block 0, 1, ...; the
document table (ids, null marks, lengths); the chunk index (JSON: for each block
its ids and the byte lengths of its planes); the index's offset and length;
magic. A reader finds any block from the index without decoding others.

Defined results: a null text counts as empty and gives the end id alone; rows
are ordered by (key, text hash), null keys first; repeated keys stay separate
documents; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filesystem, materialize, scratch, shuffle_partitions, text_or_empty, write_whole

MAGIC = b"IDPLANE1"
#: Ids in a block.
BLOCK_IDS = 1 << 16
#: Bytes of text that one file takes.
FILE_TEXT_BYTES = 64 << 20
#: Entries and characters of a worker's table of encoded words and runs of words; it starts anew when full. Longer runs are not kept.
CACHE_WORDS, CACHE_CHARACTERS, LONGEST_RUN = 700_000, 32 << 20, 256
#: Texts encoded together.
TEXTS = 256


def split_planes(ids, width: int, kind: str) -> list[bytes]:
    """The planes of one block: width bytes an id, or 8 * width bits, least significant first."""
    import numpy as np

    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    if kind == "byte":
        return [np.ascontiguousarray(octets[:, k]).tobytes() for k in range(width)]
    bits = np.unpackbits(np.ascontiguousarray(octets), axis=1, bitorder="little")
    return [np.packbits(np.ascontiguousarray(bits[:, k]), bitorder="little").tobytes() for k in range(8 * width)]


def join_planes(planes: list[bytes], n: int, width: int, kind: str):
    """The ids of one block."""
    import numpy as np

    octets = np.zeros((n, 4), np.uint8)
    if kind == "byte":
        for k, p in enumerate(planes):
            octets[:, k] = np.frombuffer(p, np.uint8)
    else:
        bits = np.zeros((n, 8 * width), np.uint8)
        for k, p in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
        octets[:, :width] = np.packbits(bits, axis=1, bitorder="little")
    return octets.view("<u4").ravel()


def file_parts(docs, width: int, kind: str = "byte", block: int = BLOCK_IDS, level: int = 3):
    """The byte strings of a file of (doc_id or None, ids) pairs; totals are in the index."""
    import numpy as np
    import zstandard

    pack = zstandard.ZstdCompressor(level=level).compress
    yield MAGIC
    at, index, keys, nulls, lengths = len(MAGIC), [], [], [], []
    held, count = [], 0

    def blocks(final: bool):
        nonlocal held, count
        ids = np.concatenate(held) if held else np.zeros(0, "<u4")
        end = len(ids) if final else len(ids) - len(ids) % block
        for a in range(0, end, block):
            part = ids[a : min(a + block, end)]
            planes = [pack(p) for p in split_planes(part, width, kind)]
            index.append([len(part), [len(p) for p in planes]])
            yield from planes
        held = [ids[end:]]
        count = len(ids) - end

    for key, ids in docs:
        keys.append(key or 0)
        nulls.append(key is None)
        lengths.append(len(ids))
        held.append(ids)
        count += len(ids)
        if count >= 16 * block:
            for p in blocks(False):
                at += len(p)
                yield p
    for p in blocks(True):
        at += len(p)
        yield p
    table = [pack(np.array(keys, "<i8").tobytes()), pack(np.array(nulls, np.uint8).tobytes()), pack(np.array(lengths, "<u8").tobytes())]
    yield from table
    described = json.dumps({"kind": kind, "width": width, "docs": len(keys), "table": [at, *map(len, table)], "blocks": index}).encode()
    at += sum(map(len, table))
    yield described
    yield struct.pack("<QQ", at, len(described)) + MAGIC


class IdFile:
    """Random and sequential access to one file."""

    def __init__(self, uri: str):
        fs, path = filesystem(uri)
        self.source = fs.open_input_file(path)
        size = self.source.size()
        at, length, magic = struct.unpack("<QQ8s", self._bytes(size - 24, 24))
        if magic != MAGIC or self._bytes(0, 8) != MAGIC:
            raise ValueError(f"{uri} is not a token-id file")
        self.index = json.loads(self._bytes(at, length))
        self.starts, at = [], len(MAGIC)
        for _, planes in self.index["blocks"]:
            self.starts.append(at)
            at += sum(planes)

    def _bytes(self, at: int, n: int) -> bytes:
        return self.source.read_at(n, at)

    def block(self, k: int):
        import zstandard

        n, lengths = self.index["blocks"][k]
        data, at, planes = self._bytes(self.starts[k], sum(lengths)), 0, []
        for size in lengths:
            planes.append(zstandard.ZstdDecompressor().decompress(data[at : at + size]))
            at += size
        return join_planes(planes, n, self.index["width"], self.index["kind"])

    def table(self):
        import numpy as np
        import zstandard

        at, *sizes = self.index["table"]
        out = []
        for size, kind in zip(sizes, ("<i8", np.uint8, "<u8")):
            out.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(self._bytes(at, size)), kind))
            at += size
        return out

    def docs(self):
        """(doc_id or None, list of id arrays) of every document, a block in memory at a time and the rest of the last one."""
        keys, nulls, lengths = self.table()
        k, ids = 0, None
        for key, null, need in zip(keys.tolist(), nulls.tolist(), lengths.tolist()):
            parts = []
            while need:
                if ids is None or not len(ids):
                    ids, k = self.block(k), k + 1
                parts.append(ids[:need])
                ids = ids[need:]
                need -= len(parts[-1])
            yield (None if null else key), parts

    def close(self) -> None:
        self.source.close()


_ENCODERS: dict[str, WordEncoder] = {}
# The word tokenizer's own splitting rule, for lower-case text in which only the characters below occur.
_PLAIN = "\\t\\n\\x0b\\x0c\\r -~\\xa0-\\u012f"
_LETTER, _DIGIT, _BLANK = "a-z\\xaa\\xb5\\xba\\xdf-\\xf6\\xf8-\\u012f", "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe", " \\t\\n\\x0b\\x0c\\r\\xa0"
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^{_BLANK}{_LETTER}{_DIGIT}]+")
UNUSUAL = re.compile(f"[^{_PLAIN}]")
#: Runs without white space that hold any other character go to the library as they are.
OTHER = re.compile(f"([^ \\t\\n\\r]*[^{_PLAIN}][^ \\t\\n\\r]*)")


class Runs(dict):
    """Ids of runs without white space, in lower case and of the characters above, and of their words, each encoded when it is first asked for."""

    def __init__(self, model):
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenize, self.bytewise = model.tokenize, ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.characters = 0

    def _word(self, word: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(word if word.isascii() else self.bytewise(word)[0][0])]).tobytes()

    def __missing__(self, run: str) -> bytes:
        if run.isalpha() or len(words := WORDS.findall(run)) == 1:
            ids = self._word(run)
        else:
            ids = b"".join([self[w] for w in words])
        if len(run) <= LONGEST_RUN:
            self[run] = ids
            self.characters += len(run)
        return ids

    def clear(self) -> None:
        super().clear()
        self.characters = 0


class WordEncoder:
    """Ids of whole texts by a word tokenizer file, each word encoded once while the table lasts.

    Such a tokenizer drops white space and its model sees each word alone, so a
    text's ids are those of its words in order. No word holds white space, so a
    text is looked up by runs without any, and only new runs are split.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        if not self.tokenizer.model.end_of_word_suffix:
            raise ValueError(f"{path} has no suffix for word ends")
        self.words = Runs(self.tokenizer.model)
        self.runs: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    @classmethod
    def shared(cls, path: str) -> WordEncoder:
        """The worker's own encoder, which keeps its table from task to task."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def _library(self, run: str) -> bytes:
        """Ids of a run that the plain rule does not cover."""
        if (got := self.runs.get(run)) is None:
            got = array("I", self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()
            if len(run) <= LONGEST_RUN:
                if len(self.runs) > self.limit // 8:
                    self.runs.clear()
                self.runs[run] = got
        return got

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.lower().split()))

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers."""
        out = []
        for text in texts:
            if len(self.words) > self.limit or self.words.characters > CACHE_CHARACTERS:
                self.words.clear()
            if any(x in text for x in self.special):
                out.append(self._library(text))
            elif UNUSUAL.search(text):
                out.append(b"".join([self._library(p) if k % 2 else self._plain(p) for k, p in enumerate(OTHER.split(text))]))
            else:
                out.append(self._plain(text))
        return out


def _write(folder: str, path: str, end_id: int | None, kind: str, width: int):
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, part = WordEncoder.shared(path), TaskContext.get().partitionId()
        end = b"" if end_id is None else struct.pack("<I", end_id)
        docs, ids, seen = 0, 0, False

        def pairs():
            nonlocal docs, ids, seen
            for batch in batches:
                keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for a in range(0, len(texts), TEXTS):
                    for key, coded in zip(keys[a : a + TEXTS], encoder.encode(texts[a : a + TEXTS])):
                        row = np.frombuffer(coded + end, "<u4")
                        docs, ids, seen = docs + 1, ids + len(row), True
                        yield key, row

        uri = f"{folder}/part-{part:06d}.ids"
        rows = pairs()
        first = next(rows, None)
        if first is None:
            return
        write_whole(uri, file_parts(_chain(first, rows), width, kind))
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "file": [uri], "docs": pa.array([docs], pa.int64()), "ids": pa.array([ids], pa.int64())})

    return run


def _chain(first, rest):
    yield first
    yield from rest


def _read(batches: Iterator):
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for uri, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
            source, rows = IdFile(uri), []
            for key, parts in source.docs():
                n, crc = 0, 0
                for p in parts:
                    n, crc = n + len(p), zlib.crc32(np.ascontiguousarray(p), crc)
                rows.append((key, base, n, crc))
                base += n
                if len(rows) == 8192:
                    yield _rows(rows)
                    rows = []
            source.close()
            yield _rows(rows)


def _rows(rows: list[tuple]):
    import pyarrow as pa

    columns = list(zip(*rows)) or [(), (), (), ()]
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "start", "n_tokens", "ids_crc32"), columns)})


def write_token_files(
    df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", end_id: int | None = 2, kind: str = "byte", folder: str | None = None, file_bytes: int = FILE_TEXT_BYTES
) -> DataFrame:
    """Writes the ids of all texts in ascending key order and returns the manifest: part, file, docs, ids, base.

    tokenizer: path of a tokenizer file that exists on every machine. base: ids
    in the files before.
    """
    from tokenizers import Tokenizer

    spark = df.sparkSession
    largest = max(Tokenizer.from_file(tokenizer).get_vocab_size() - 1, end_id or 0)
    width = max(1, -(-largest.bit_length() // 8))
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    rows = df.select(F.col(key).cast("long").alias("k"), text_or_empty(text).alias("t"))
    rows = rows.repartitionByRange(shuffle_partitions(spark, total, file_bytes), F.col("k"), F.xxhash64("t")).sortWithinPartitions("k", F.xxhash64("t"))
    written = rows.mapInArrow(_write(folder or scratch(spark, "ids"), tokenizer, end_id, kind, width), "part long, file string, docs long, ids long")
    manifest = materialize(written, "ids-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return manifest.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    files = max(manifest.count(), 1)
    return manifest.select("file", "base").repartition(files, "file").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
