"""Katz backoff language model of any order, trained and evaluated over whole tables.

P(w | h) is the Good-Turing discounted relative frequency where the n-gram (h, w)
occurs in training, else alpha(h) P(w | h'), h' being h without its first word;
P(w) is the discounted frequency of the word, and the mass that discounting frees
belongs to one class of unknown words. alpha(h) = (1 - sum of the seen P(w | h)) /
(1 - sum of P(w | h') over the same words), so every context sums to one over the
vocabulary and the unknown class. Discounts are estimated for each level.

Neither the vocabulary nor the n-grams fit one machine, and a row for each
occurrence would cost many times the input. So texts become chunks of some
million tokens (a list of word hashes and the tokens as places in it), kept as
files in the shared folder, and chunks and model partitions exchange sorted,
packed blocks, level after level:

  1. words: each chunk sends its words' counts to the partition of their hash;
     partitions add them up and answer with totals and with an id for each word;
  2. n-grams: each chunk sends, to the partition of the context's id, the ids of
     contexts and last words with its own counts and the totals of (h', w);
     partitions add up and answer with totals, ids, and for each context how many
     of its n-grams occur 1 to 5 times and how often the others, and the same
     for the totals of (h', w). That is all that alpha needs, in whole numbers;
  3. scores: each chunk evaluates its n-grams recursively and sums by document.

A context whose total is large is spread over as many partitions as its total
fills, which every chunk knows from the level before; the chunk adds up the parts
of the context's numbers. Where there are more partitions than FAN, a chunk does
not send a block to each: chunks in bundles first merge what they have for a range
of partitions, and answers come back the same way, so that blocks stay large.

Only counts of counts reach the driver: one row a level.

Defined results: a null text counts as empty and has its end token alone; tokens
are runs without white space, A-Z in lower case, then one end; a text's first
word follows an end token, and near the beginning, contexts are as long as the
text allows; repeated ids are rows like others; with no training row everything
is the unknown class with probability 1; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WholeFile, discard, filesystem, scratch, shuffle_partitions, text_or_empty
from .near_dedup import mix

ORDER = 3
#: Rows whose crc32(id) modulo HELD_OUT[0] is HELD_OUT[1] are scored but not learned from.
HELD_OUT = (10, 0)
#: Counts above this are not discounted.
LARGEST = 5
CHUNK_TOKENS = 700_000
#: Bytes of text for each model partition.
PARTITION_TEXT = 16 << 20
#: A context is spread over a partition more for every SPREAD times the mean of a partition that its total reaches.
SPREAD = 4
#: Blocks that a chunk sends at most; beyond so many partitions it sends to ranges of them.
FAN = 2048
#: Chunks are scored in so many turns, so that only a part of all answers is in the shuffle at a time.
TURNS = 2
END = b" "
#: Added to the folder of the chunks: that of the hashes of their words, which go after level 1.
WORDS = "-words"


class Hashes(dict):
    """64-bit hashes of tokens, kept while the table stays small."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = Hashes()


#: Marks packed differences.
DIFFERENCES = 0x80


def pack(values, mark: int = 0) -> bytes:
    """Unsigned integers as byte planes, compressed."""
    import numpy as np
    import zstandard

    x = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width | mark]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def pack_sorted(values) -> bytes:
    """As pack(), by differences; also right, if not small, where values fall."""
    import numpy as np

    return pack(np.diff(values, prepend=np.uint64(0)), DIFFERENCES)


def unpack(data: bytes):
    import numpy as np
    import zstandard

    width, planes = data[0] & ~DIFFERENCES, np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = planes.reshape(width, -1).T
    values = out.view("<u8").ravel()
    return np.cumsum(values, dtype=np.uint64) if data[0] & DIFFERENCES else values


def tokens_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def _is_held(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1]


# ---------------------------------------------------------------- discounts


def discounts(n: list[int]):
    """d[r] for r = 0..LARGEST from n[r], the number of types that occur r times (n[1..LARGEST + 1]).

    Where the counts of counts give no proper discount, half an occurrence is taken off.
    """
    import numpy as np

    d = np.ones(LARGEST + 1)
    rest = (LARGEST + 1) * n[LARGEST + 1] / n[1] if n[1] else 1.0
    for r in range(1, LARGEST + 1):
        value = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if n[r] and rest < 1 else 0.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


def discounted(counts, d):
    """d[r] * r for each count."""
    import numpy as np

    return np.where(counts > LARGEST, 1.0, d[np.minimum(counts, LARGEST)]) * counts


class Words:
    """P(w) from the counts of counts of words: discounted frequencies and one unknown class."""

    def __init__(self, tokens: int, types: int, n: list[int]):
        self.tokens, self.types, self.d = tokens, types, discounts(n)
        kept = 1 - sum((1 - self.d[r]) * r * n[r] for r in range(1, LARGEST + 1)) / tokens if tokens else 0.0
        self.unknown = max(1 - kept, 1 / (tokens + 1))
        #: what a discounted count is divided by
        self.whole = tokens * kept / (1 - self.unknown) if tokens else 1.0

    def p(self, counts):
        import numpy as np

        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, discounted(counts, self.d) / self.whole, self.unknown)

    def base(self, counts):
        return (counts.astype(float) + 0.1) / (self.tokens + 0.1 * (self.types + 1))


# ---------------------------------------------------------------- chunks


def _chunks(folder: str, limit: int):
    """Writes chunks to a file of the task, the hashes of their words to another, and yields their names, which say where they are."""

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        end, name, names, files = np.array([_HASHES[END]], np.uint64), uuid.uuid4().hex[:12], [], []

        def chunk(ids, arrays):
            if not files:
                files.extend(WholeFile(f"{folder}{kind}/{name}") for kind in ("", WORDS))
            lengths = np.fromiter(map(len, arrays), np.uint64, len(arrays))
            words, tokens = np.unique(np.concatenate(arrays), return_inverse=True)
            columns = [pa.array([ids], pa.list_(pa.int64())), *[pa.array([x], pa.binary()) for x in (pack(lengths), pack(tokens))]]
            batch = pa.RecordBatch.from_arrays(columns, ["ids", "lengths", "tokens"])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            at = [f.size for f in files]
            for file, data in zip(files, (sink.getvalue().to_pybytes(), pack_sorted(words))):
                file.write(data)
            names.append("-".join([name, *[f"{a}-{f.size - a}" for a, f in zip(at, files)]]))

        ids, arrays, count = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                runs = tokens_of(text)
                ids.append(doc_id)
                arrays.append(np.concatenate([np.fromiter(map(_HASHES.__getitem__, runs), np.uint64, len(runs)), end]))
                count += len(runs) + 1
                if count >= limit:
                    chunk(ids, arrays)
                    ids, arrays, count = [], [], 0
        if ids:
            chunk(ids, arrays)
        for file in files:
            file.close()
        _HASHES.clear()  # the worker has other things to hold
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["origin"])

    return run


def _read(folder: str, file: str, offset: str, size: str) -> bytes:
    fs, path = filesystem(f"{folder}/{file}")
    with fs.open_input_file(path) as source:
        return source.read_at(int(size), int(offset))


def _part_of(hashes, parts: int):
    """Partition by the upper half of the hash: ascending with the hash."""
    import numpy as np

    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


class Level:
    """The distinct n-grams of one level in a chunk, in the order in which they are sent.

    at: the n-gram that ends at each token, or -1; context, suffix: its first and
    last words as n-grams of the level below; last: its last word. block_*: the
    contexts with their partitions, as sent, and the n-grams of each.
    """

    def __init__(self, chunk: "Chunk", below: "Level | None"):
        import numpy as np

        if below is None:
            self.at, self.n = chunk.tokens, int(chunk.tokens.max()) + 1
            return
        words, k = chunk.levels[0], len(chunk.levels) + 1
        place = np.flatnonzero(chunk.place >= k - 2)
        before = below.at[np.maximum(place - 1, 0)].astype(np.int64)
        if k == 2:
            before = np.where(chunk.place[place] == 0, chunk.end, before)
        grams, inverse = np.unique(before * words.n + chunk.tokens[place], return_inverse=True)
        context, last, n = grams // words.n, grams % words.n, len(grams)
        suffix = np.empty(n, np.int32)
        suffix[inverse] = below.at[place]
        home, over = below.part.astype(np.int64), chunk.spread(below.total)
        part = home[context]
        wide = over[context] > 1
        part[wide] = (part[wide] + (mix(words.ids[last[wide]]) % over[context[wide]].astype(np.uint64)).astype(np.int64)) % chunk.parts
        # n-grams are in order of (context, word), so a stable sort by partition keeps that order within each
        order = np.argsort(part, kind="stable")
        turned = np.empty(n, np.int32)
        turned[order] = np.arange(n)
        self.n, part = n, part[order]
        self.part = part.astype(np.int32)
        self.context, self.last, self.suffix = (x[order].astype(np.int32) for x in (context, last, suffix))
        self.at = np.full(len(chunk.tokens), -1, np.int32)
        self.at[place] = turned[inverse]
        # contexts by partition; a spread one is asked for in all its partitions, so that its numbers are whole
        codes = part * below.n + self.context
        rows = codes[np.concatenate([[True], np.diff(codes) != 0])] if n else codes
        spread = np.flatnonzero((over > 1) & (np.bincount(self.context, minlength=below.n) > 0))
        if len(spread):
            more = [((home[c] + np.arange(over[c])) % chunk.parts) * below.n + c for c in spread.tolist()]
            rows = np.union1d(rows, np.concatenate(more))
        self.block_part, self.block_context = rows // below.n, rows % below.n
        self.block_size = np.bincount(np.searchsorted(rows, codes), minlength=len(rows))
        self.over = over

    def ask_for_words(self, hashes, parts: int) -> None:
        """Level 1 is sent as contexts with an n-gram each."""
        import numpy as np

        self.hashes, self.block_size, self.block_part = hashes, np.ones(self.n, np.int64), _part_of(hashes, parts)

    def in_order_of_ids(self) -> None:
        """Words are numbered by frequency, not by hash; the chunk follows."""
        import numpy as np

        order = np.argsort(self.ids)
        turned = np.empty(self.n, np.int32)
        turned[order] = np.arange(self.n)
        self.ids, self.total, self.at = self.ids[order], self.total[order], turned[self.at]
        self.part = (self.ids >> np.uint64(32)).astype(np.int32)

    def answer(self, rows: list[dict]) -> None:
        """Takes totals and, if there are any, ids."""
        import numpy as np

        self.total, self.ids = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if self.n:
            self.total = np.concatenate([unpack(r["totals"]) for r in rows]).astype(np.int64)
            self.ids = np.concatenate([unpack(r["ids"]) for r in rows if r["ids"] is not None] or [self.ids])

    def weigh(self, rows: list[dict], below: "Level", d, d_below, words: Words) -> None:
        """From the numbers of contexts what p() needs: whole (what a discounted count is divided by) and alpha's terms.

        A context's n-grams occur as often as the context itself, as every one is followed by something.
        """
        import numpy as np

        parts = Numbers.read(rows).sums(d, d_below)
        of = np.zeros((3, below.n))
        once = self.over[self.block_context] <= 1
        of[:, self.block_context[once]] = parts[:, once]
        for row, part in zip(of, parts):
            np.add.at(row, self.block_context[~once], part[~once])
        self.kept, self.lower, discounted_ones = of
        # a context without a discounted n-gram gets one more occurrence, so that something is left for the others
        self.whole = below.total + ((discounted_ones == 0) & (below.total > 0)).astype(float)
        self.d, self.words = d, words

    def p(self, below: "Level | None", p_below, words: Words):
        """P(last word | context) of every n-gram, from those of the level below."""
        import numpy as np

        if below is None:
            return words.p(self.total)
        backed, c = p_below[self.suffix], self.context
        under = words.whole if not hasattr(below, "whole") else below.whole[below.context[self.suffix]]
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = (1 - self.kept[c] / self.whole[c]) / (1 - self.lower[c] / under)
            seen = discounted(self.total, self.d) / self.whole[c]
        return np.where(self.whole[c] == 0, backed, np.where(self.total > 0, seen, alpha * backed))


class Chunk:
    """A chunk, its n-grams up to a level, and what the partitions have answered on those below it."""

    def __init__(self, folder: str, name: str, parts: int, tokens: int = 0):
        import numpy as np
        import pyarrow as pa

        file, *self.where = name.split("-")
        row = pa.ipc.open_stream(_read(folder, file, *self.where[:2])).read_all().to_pylist()[0]
        self.parts, self.mean = parts, max(tokens / parts, 1.0)
        self.ids, self.lengths = row["ids"], unpack(row["lengths"]).astype(np.int64)
        self.tokens = unpack(row["tokens"]).astype(np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)
        self.end = int(self.tokens[-1])
        self.train = np.repeat(~np.array([_is_held(i) for i in self.ids], bool), self.lengths)
        self.levels: list[Level] = []

    def spread(self, total):
        """Partitions of each context by its total."""
        import numpy as np

        return np.clip(np.ceil(total / (SPREAD * self.mean)), 1, self.parts).astype(np.int64)

    def climb(self, answers: dict[int, list[dict]]) -> None:
        """Adds a level; all that are there must have been answered."""
        if self.levels:
            self.answer(answers)
        self.levels.append(Level(self, self.levels[-1] if self.levels else None))

    def answer(self, answers: dict[int, list[dict]]) -> None:
        """Gives the highest level its answers."""
        self.levels[-1].answer(answers.get(len(self.levels), []))
        if len(self.levels) == 1 and len(self.levels[0].ids):
            self.levels[0].in_order_of_ids()
            self.tokens, self.end = self.levels[0].at, int(self.levels[0].at[-1])

    def requests(self, name: str, width: int) -> list[tuple]:
        """The blocks of the highest level, one for each `width` partitions."""
        import numpy as np

        top = self.levels[-1]
        counts = np.bincount(top.at[self.train & (top.at >= 0)], minlength=top.n)
        if len(self.levels) == 1:
            nothing = np.zeros(top.n, np.int64)
            return blocks(name, width, top.block_part, top.hashes, top.block_size, nothing > 0, nothing.view(np.uint64), counts, nothing, False)
        below, words = self.levels[-2], self.levels[0]
        lower = below.total[top.suffix]
        lower = lower if len(self.levels) == 2 else lower * (counts > 0)
        wide = top.over[top.block_context] > 1
        return blocks(name, width, top.block_part, below.ids[top.block_context], top.block_size, wide, words.ids[top.last], counts, lower, len(self.levels) == 2)

    def probabilities(self, level: int, words: Words):
        """P of every n-gram of a level, by recursion over the levels below."""
        below = self.levels[level - 2] if level > 1 else None
        return self.levels[level - 1].p(below, self.probabilities(level - 1, words) if below is not None else None, words)


# ---------------------------------------------------------------- exchange


BLOCK = "part int, origin string, parts binary, contexts binary, sizes binary, next binary, counts binary, lower binary"
ANSWER = "origin string, first int, totals binary, ids binary, kinds binary, few binary, many binary, n array<long>"
#: Kinds of contexts: numbers spelled out; not asked for, with a discounted n-gram; not asked for, without one. Others have no n-gram, or a single one with small counts.
SPELLED, HAS_FEW, ALL_MANY = 255, 254, 253


class Numbers:
    """What alpha needs of contexts: how many of their n-grams occur 1 to LARGEST times and how often the others, and the same for the totals of (h', w).

    kinds: 0 for a context without n-grams, 1 + LARGEST * (r - 1) + (l - 1) for one
    with a single n-gram of count r whose (h', w) occurs l times, SPELLED for those
    of which few and many hold a column each. A chunk that has no unseen n-gram of
    a context needs no alpha, so it is told only whether any is discounted.
    """

    def __init__(self, kinds, few, many):
        import numpy as np

        self.kinds, self.few, self.many = kinds, few, many
        self.column = np.cumsum(kinds == SPELLED, dtype=np.int32) - 1

    @classmethod
    def of(cls, owner, count, lower, rows: int) -> "Numbers":
        """owner: the context of each n-gram."""
        import numpy as np

        seen = count > 0
        owner, count, lower = owner[seen], count[seen], lower[seen]
        single = (np.bincount(owner, minlength=rows) == 1)[owner] & (count <= LARGEST) & (lower <= LARGEST)
        kinds = np.zeros(rows, np.uint8)
        kinds[owner] = SPELLED
        kinds[owner[single]] = 1 + (count[single] - 1) * LARGEST + lower[single] - 1
        out = cls(kinds, None, None)
        owner, count, lower, n = out.column[owner[~single]], count[~single], lower[~single], int((kinds == SPELLED).sum())
        # contexts with one n-gram that is not small are here, too
        out.few = np.stack([np.bincount(owner[x == r], minlength=n).astype(np.int32) for x in (count, lower) for r in range(1, LARGEST + 1)])
        out.many = np.stack([np.bincount(owner, np.where(x > LARGEST, x, 0), n).astype(np.int64) for x in (count, lower)])
        return out

    def packed(self, rows, asked) -> tuple[bytes, bytes, bytes]:
        import numpy as np

        kinds = self.kinds[rows]
        spelled = kinds == SPELLED
        columns = self.column[rows[spelled & asked]]
        has_few = kinds != ALL_MANY
        has_few[spelled] = (self.few[:LARGEST, self.column[rows[spelled]]] > 0).any(axis=0)
        kinds = np.where(asked, kinds, np.where(has_few, HAS_FEW, ALL_MANY))
        return pack(kinds), pack(self.few[:, columns].ravel()), pack(self.many[:, columns].ravel())

    @classmethod
    def read(cls, rows: list[dict]) -> "Numbers | None":
        import numpy as np

        if rows[0]["kinds"] is None:
            return None
        columns = [[unpack(r["kinds"]).astype(np.uint8), unpack(r["few"]).reshape(2 * LARGEST, -1), unpack(r["many"]).reshape(2, -1)] for r in rows]
        return cls(*[np.concatenate(x, axis=-1) for x in zip(*columns)])

    def sums(self, d, d_below):
        """For each context: the discounted total of its n-grams, the discounted sum of the totals of (h', w), and how many are discounted."""
        import numpy as np

        r = np.arange(LARGEST + 1)
        spelled, single = self.kinds == SPELLED, np.flatnonzero((self.kinds > 0) & (self.kinds < ALL_MANY))
        out = np.zeros((3, len(self.kinds)))
        code = self.kinds[single].astype(np.int64) - 1
        count, lower = code // LARGEST + 1, code % LARGEST + 1
        out[0, single], out[1, single], out[2, single] = (d * r)[count], (d_below * r)[lower], 1
        few, many = self.few.astype(float), self.many.astype(float)
        added = lambda factors, counts, rest: sum((f * c for f, c in zip(factors[1:], counts)), rest)
        out[:, spelled] = added(d * r, few[:LARGEST], many[0]), added(d_below * r, few[LARGEST:], many[1]), few[:LARGEST].sum(axis=0)
        out[2, self.kinds == HAS_FEW] = 1
        return out


def _cuts(p):
    """Starts and ends of the runs of equal values."""
    import numpy as np

    at = np.flatnonzero(np.diff(p)) + 1
    return zip(np.concatenate([[0], at]).tolist(), np.concatenate([at, [len(p)]]).tolist()) if len(p) else ()


def blocks(origin: str, width: int, part, context, size, wide, following, count, lower, of_word: bool) -> list[tuple]:
    """wide: whether a context is spread; of_word: lower belongs to the following word alone and is sent once for each."""
    import numpy as np

    ends = np.concatenate([[0], np.cumsum(size)])
    out = []
    for a, b in _cuts(part // width):
        x, y = int(ends[a]), int(ends[b])
        low = lower[x:y]
        if of_word:
            low = low[np.unique(following[x:y], return_index=True)[1]]
        out.append((
            int(part[a]) // width, origin, pack_sorted(part[a:b].astype(np.uint64)), pack_sorted(context[a:b]), pack(2 * size[a:b] + wide[a:b]),
            pack(following[x:y]), pack(count[x:y]), pack(low),
        ))
    return out


def _block_table(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.int32(), pa.string(), *[pa.binary()] * 6)
    names = ["part", "origin", "parts", "contexts", "sizes", "next", "counts", "lower"]
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*rows)) or [()] * 8, kinds)], names=names)


def _answer_table(rows: list[tuple]):
    import pyarrow as pa

    kinds = (pa.string(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64()))
    names = ["origin", "first", "totals", "ids", "kinds", "few", "many", "n"]
    return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*rows)) or [()] * 8, kinds)], names=names)


class Merged:
    """Blocks added up: distinct (partition, context) rows and their distinct n-grams in order, and where each block's rows went."""

    def __init__(self, group, of_word: bool):
        import numpy as np

        rows = group.sort_by("origin")
        self.origins = rows.column("origin").to_pylist()
        read = lambda name, how: [how(x) for x in rows.column(name).to_pylist()]
        part, context = (np.concatenate(read(n, unpack)) for n in ("parts", "contexts"))
        sizes, self.wide = zip(*[(x >> np.uint64(1), (x & np.uint64(1)).astype(bool)) for x in read("sizes", unpack)])
        self.rows, self.grams = [len(x) for x in sizes], [int(x.sum()) for x in sizes]
        order = np.lexsort((context, part)) if len(part) and part.min() != part.max() else np.argsort(context, kind="stable")
        fresh = np.concatenate([[True], (np.diff(context[order]) != 0) | (np.diff(part[order]) != 0)])[: len(order)]
        self.row = np.empty(len(order), np.int32)
        self.row[order] = np.cumsum(fresh) - 1
        self.part, self.context = part[order[fresh]].astype(np.int64), context[order[fresh]]
        owner = np.repeat(self.row, np.concatenate(sizes).astype(np.int64))
        following, lower = read("next", unpack), read("lower", unpack)
        if of_word:
            lower = [low[np.unique(f, return_inverse=True)[1]] for f, low in zip(following, lower)]
        following, lower = np.concatenate(following), np.concatenate(lower)
        # an id is a partition and a number in it; with the owner's number it mostly fits 63 bits
        high, low = (following >> np.uint64(32)).astype(np.int64), (following & np.uint64((1 << 32) - 1)).astype(np.int64)
        wide = int(low.max(initial=0)) + 1
        span = (int(high.max(initial=0)) + 1) * wide
        if len(self.part) * span < 1 << 63:
            codes = owner.astype(np.int64) * span + high * wide + low
            order = np.argsort(codes)
            fresh = np.concatenate([[True], np.diff(codes[order]) != 0])[: len(order)]
        else:
            order = np.lexsort((following, owner))
            fresh = np.concatenate([[True], (np.diff(owner[order]) != 0) | (np.diff(following[order]) != 0)])[: len(order)]
        high = low = codes = None
        self.gram = np.empty(len(order), np.int32)
        self.gram[order] = np.cumsum(fresh) - 1
        first = order[fresh]
        self.owner, self.next = owner[first], following[first]
        n = len(first)
        self.count = np.bincount(self.gram, np.concatenate(read("counts", unpack)), minlength=n).astype(np.int64)
        self.lower = np.maximum.reduceat(lower[order], np.flatnonzero(fresh)).astype(np.int64) if n else np.zeros(0, np.int64)
        self.size = np.bincount(self.owner, minlength=len(self.part))
        self.sizes = sizes

    def is_wide(self):
        import numpy as np

        return np.bincount(self.row, np.concatenate(self.wide), len(self.part)) > 0

    def back(self, first: int, totals, ids, numbers: Numbers | None) -> list[tuple]:
        """An answer for every block."""
        import numpy as np

        sorted_ids = ids is not None and bool((np.diff(ids.view(np.int64)) > 0).all())
        out, a, x = [], 0, 0
        for origin, rows, grams, sizes, wide in zip(self.origins, self.rows, self.grams, self.sizes, self.wide):
            row, gram = self.row[a : a + rows], self.gram[x : x + grams]
            # alpha is for contexts with an unseen n-gram here; of spread ones nobody sees all
            unseen = np.bincount(np.repeat(np.arange(rows), sizes.astype(np.int64)), totals[gram] == 0, rows) > 0
            out.append((
                origin, first, pack(totals[gram]), None if ids is None else pack_sorted(ids[gram]) if sorted_ids else pack(ids[gram]),
                *((None, None, None) if numbers is None else numbers.packed(row, unseen | wide)), None,
            ))
            a, x = a + rows, x + grams
        return out


def _add(level: int, order: int):
    """One partition: totals, ids and the numbers of contexts to every block, and the counts of counts."""

    def run(group):
        import numpy as np

        part = group.column("part")[0].as_py()
        m = Merged(group, level == 2)
        numbers = Numbers.of(m.owner, m.count, m.lower, len(m.part)) if level > 1 else None
        ids = None
        if level < order:
            number = np.arange(len(m.count), dtype=np.uint64)
            if level == 1:  # words by frequency, which makes small numbers frequent
                number[np.argsort(-m.count, kind="stable")] = np.arange(len(m.count), dtype=np.uint64)
            ids = (np.uint64(part) << np.uint64(32)) | number
        n = np.bincount(np.minimum(m.count, LARGEST + 2), minlength=LARGEST + 3)[: LARGEST + 2].tolist()
        return _answer_table([*m.back(part, m.count, ids, numbers), (None, part, None, None, None, None, None, [int(m.count.sum()), int((m.count > 0).sum()), *n])])

    return run


def _onward(of_word: bool):
    """What a bundle of chunks has for a range of partitions, merged, a block for each partition."""

    def run(group):
        m = Merged(group, of_word)
        name = f"{group.column('bundle')[0].as_py()}:{group.column('part')[0].as_py()}"
        return _block_table(blocks(name, 1, m.part, m.context, m.size, m.is_wide(), m.next, m.count, m.lower, of_word))

    return run


def _homeward(staged, replies):
    """The partitions' answers to a bundle, taken apart for its chunks."""
    import numpy as np

    if not staged.num_rows:
        return _answer_table([])
    m, rows = Merged(staged.drop_columns("lower").append_column("lower", staged.column("counts")), False), replies.sort_by("first").to_pylist()
    both = lambda name, how: None if rows[0][name] is None else how([r[name] for r in rows])
    totals = np.concatenate([unpack(r["totals"]) for r in rows]).astype(np.int64)
    ids = both("ids", lambda xs: np.concatenate([unpack(x) for x in xs]))
    return _answer_table(m.back(staged.column("part")[0].as_py(), totals, ids, Numbers.read(rows)))


def _ask(folder: str, level: int, parts: int, width: int, tokens: int):
    def words(batches: Iterator):
        for batch in batches:
            for name in batch.column("origin").to_pylist():
                chunk = Chunk(folder, name, parts)
                chunk.climb({})
                file, *_, offset, size = name.split("-")
                chunk.levels[0].ask_for_words(unpack(_read(f"{folder}{WORDS}", file, offset, size)), parts)
                yield from _block_table(chunk.requests(name, width)).to_batches()

    def grams(group):
        name, answers = group.column("origin")[0].as_py(), _by_level(group)
        chunk = Chunk(folder, name, parts, tokens)
        for _ in range(level):
            chunk.climb(answers)
        return _block_table(chunk.requests(name, width))

    return words if level == 1 else grams


def _by_level(group) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for row in group.sort_by("first").to_pylist():
        out.setdefault(row["level"], []).append(row)
    return out


SCORE = "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(folder: str, order: int, parts: int, words: Words, d: list):
    def run(group):
        import numpy as np
        import pyarrow as pa

        answers = _by_level(group)
        chunk = Chunk(folder, group.column("origin")[0].as_py(), parts, words.tokens)
        for _ in range(order):
            chunk.climb(answers)
        chunk.answer(answers)
        for k in range(2, order + 1):
            if chunk.levels[k - 1].n:
                chunk.levels[k - 1].weigh(answers[k], chunk.levels[k - 2], d[k - 1], d[k - 2], words)
        log_p = np.zeros(len(chunk.tokens))
        for k in range(1, order + 1):  # a token is evaluated at the highest level that it has
            level = chunk.levels[k - 1]
            here = (level.at >= 0) & (chunk.place >= k - 2) & ((chunk.place == k - 2) | (k == order))
            if here.any():
                log_p[here] = np.log10(chunk.probabilities(k, words))[level.at[here]]
        counts = chunk.levels[0].total
        score, base = np.add.reduceat(log_p, chunk.starts), np.add.reduceat(np.log10(words.base(counts))[chunk.tokens], chunk.starts)
        known = np.add.reduceat((counts > 0)[chunk.tokens].astype(np.int64), chunk.starts)
        return pa.Table.from_arrays(
            [pa.array(chunk.ids, pa.int64()), pa.array(chunk.lengths), pa.array(known), pa.array(np.full(len(chunk.ids), words.tokens)), pa.array(base), pa.array(score)],
            names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return run


def katz_scores(
    df: DataFrame, text: str = "text", key: str = "doc_id", order: int = ORDER, chunk_tokens: int = CHUNK_TOKENS, partition_text: int = PARTITION_TEXT, fan: int = FAN
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of df."""
    spark = df.sparkSession
    work, folder = Scratch(spark, "katz"), scratch(spark, "katz-text")
    docs = df.select(F.col(key).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = shuffle_partitions(spark, size, partition_text)
    width = 1 if parts <= fan else math.ceil(math.sqrt(parts))
    chunks = work.keep(docs.mapInArrow(_chunks(folder, chunk_tokens), "origin string"), "chunks")
    bundles = math.ceil(chunks.count() / math.ceil(parts / width))
    bundle = F.pmod(F.xxhash64("origin"), F.lit(max(bundles, 1))).cast("int")

    answers, d, words = [], [], Words(0, 0, [0] * (LARGEST + 2))
    for level in range(1, order + 1):
        ask = _ask(folder, level, parts, width, words.tokens)
        sent = chunks.mapInArrow(ask, BLOCK) if level == 1 else _all([a.drop("kinds", "few", "many") for a in answers]).groupBy("origin").applyInArrow(ask, BLOCK)
        if width > 1:
            staged = work.keep(sent.withColumn("bundle", bundle), f"staged-{level}")
            sent = staged.groupBy("bundle", "part").applyInArrow(_onward(level == 2), BLOCK)
        got = work.keep(sent.groupBy("part").applyInArrow(_add(level, order), ANSWER), f"answers-{level}")
        n = got.filter("origin is null").select(*[F.sum(F.col("n")[k]).alias(f"n{k}") for k in range(LARGEST + 4)]).first()
        n = [x or 0 for x in n]
        if level == 1:
            words = Words(n[0], n[1], n[2:])
            discard(spark, f"{folder}{WORDS}")
        d.append(discounts(n[2:]))
        got = got.filter("origin is not null")
        if width > 1:
            address = F.split("origin", ":")
            replies = got.withColumns({"bundle": address[0].cast("int"), "part": address[1].cast("int")})
            got = work.keep(staged.groupBy("bundle", "part").cogroup(replies.groupBy("bundle", "part")).applyInArrow(_homeward, ANSWER), f"home-{level}")
            work.drop(f"staged-{level}", f"answers-{level}")
        answers.append(got.select(F.lit(level).alias("level"), "origin", "first", "totals", "ids", "kinds", "few", "many"))
    # the ids of n-grams serve requests only
    answers = [a.withColumn("ids", F.when(F.col("level") == 1, F.col("ids"))) for a in answers]
    score, turn = _scores(folder, order, parts, words, d), F.pmod(F.xxhash64("origin", F.lit(order)), F.lit(TURNS))
    scored = [work.keep(_all(answers).filter(turn == k).groupBy("origin").applyInArrow(score, SCORE), f"scores-{k}") for k in range(TURNS)]
    work.drop(*[name for name in work.paths if not name.startswith("scores-")])
    discard(spark, folder)
    out = _all(scored)
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % HELD_OUT[0] == HELD_OUT[1]
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out
