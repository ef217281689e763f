"""SentencePiece encoding with seeded merge-dropout, and decoding.

A text is cut where no piece of the model can reach over, and each part is
merged from characters by an agenda: the candidate of the best score, leftmost
on ties, is taken next, or is skipped for good at the dropout rate. Whether it is
skipped is drawn from a hash of the seed, the document's id and the part's place
in the text, so that every occurrence of a word is cut for itself, yet the same
seed always gives the same ids. What is kept of a part is only which ids a set
of skipped candidates leads to. Characters without a piece become byte pieces.

The model's BPE pieces, scores and byte pieces are used; nothing is trained. At
rate 0 the ids are those of the sentencepiece library. A literal U+2581 is
written as bytes, so that decoding always gives back the text, spaces, line
ends and all.

Defined results: a null or empty text has no ids and decodes to the empty text;
repeated ids are rows like others; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import quoted, text_or_empty, unused

DROPOUT, SEED = 0.1, 20240501
#: None: every occurrence of a part is cut for itself. A number: documents are dealt to so many streams.
STREAMS = None
#: The longest part whose segmentations are kept; longer ones are merged at every occurrence.
SHORT = 32
#: Parts of texts whose ids a worker keeps, for each stream.
CACHE_PARTS = 200_000
MASK = (1 << 64) - 1
NEVER = (1 << 31) - 1
#: Texts encoded together.
TEXTS = 256


class Pieces:
    """The tables of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.bytes: list[int] = [0] * 256
        self.known: dict[str, tuple[float, int]] = {}
        self.spelled: list[bytes] = [b""] * self.size
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.spelled[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                plain = piece.replace("▁", " ")
                self.known[plain] = (-model.get_score(i), i)
                self.spelled[i] = plain.encode()
        self._tables()
        # characters that no piece joins to a character before them, but to a space or one of their own kind
        apart = {c for c in map(chr, range(1, 128)) if not (c.isalnum() or c == " ")}
        while bad := {b for p in self.known for a, b in zip(p, p[1:]) if b in apart and a not in apart and a != " "}:
            apart -= bad
        # nor does any piece join a space to what stands before it, unless that is a space too
        if any(b == " " and a != " " for p in self.known for a, b in zip(p, p[1:])):
            raise ValueError(f"{path} has pieces that end in spaces")
        x = re.escape("".join(sorted(apart)))
        self.parts = re.compile(f" *[^ {x}]+| *[{x}]+[^ {x}]*| +") if apart else re.compile(" *[^ ]+| +")


    def _tables(self) -> None:
        """Arrays for merging many parts at once: pieces of characters, and an open-addressing table of joins."""
        import numpy as np

        scores = sorted({s for s, _ in self.known.values()})
        self.rank = np.full(self.size, NEVER, np.int32)
        self.of_char = np.full(0x110000, -1, np.int32)
        self.rank[[i for _, i in self.known.values()]] = np.searchsorted(scores, [s for s, _ in self.known.values()])
        keys, values = [], []
        for piece, (_, i) in self.known.items():
            if len(piece) == 1:
                self.of_char[ord(piece)] = i
            for cut in range(1, len(piece)):
                left, right = self.known.get(piece[:cut]), self.known.get(piece[cut:])
                if left and right:
                    keys.append(left[1] * self.size + right[1])
                    values.append(i)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.join_key, self.join_piece = np.full((1 << self.bits) + 64, -1, np.int64), np.full((1 << self.bits) + 64, -1, np.int32)
        for slot, key, value in zip(self._slots(np.array(keys, np.int64)).tolist(), keys, values):
            while self.join_key[slot] >= 0:
                slot += 1
            self.join_key[slot], self.join_piece[slot] = key, value

    def _slots(self, keys):
        import numpy as np

        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def joined(self, left, right):
        """The piece that each pair of symbols makes, or -1. Characters without a piece are symbols beyond the pieces."""
        import numpy as np

        keys = left.astype(np.int64) * self.size + right
        keys[((left < 0) | (right < 0)) | ((left >= self.size) | (right >= self.size))] = -2
        slot = self._slots(keys)
        found = self.join_key[slot]
        out = np.where(found == keys, self.join_piece[slot], np.int32(-1))
        rest = np.flatnonzero((found >= 0) & (found != keys))
        while len(rest):
            slot[rest] += 1
            found, wanted = self.join_key[slot[rest]], keys[rest]
            same = found == wanted
            out[rest[same]] = self.join_piece[slot[rest[same]]]
            rest = rest[(found >= 0) & ~same]
        return out

    def symbols(self, parts: list[str]):
        """The characters of all parts as symbols: their pieces, or the model's size and the code point."""
        import numpy as np

        chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = self.of_char[chars]
        odd = np.flatnonzero(symbols < 0)
        symbols[odd] = self.size + chars[odd].astype(np.int32)
        return symbols

    def spelled_out(self, symbols, counts):
        """Rows of symbols one after the other as ids, characters without a piece as byte pieces, and the number of ids of each row."""
        import numpy as np

        odd = symbols >= self.size
        if not odd.any():
            return symbols.astype("<u4"), counts
        point = np.where(odd, symbols - self.size, 0)
        width = 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF)
        ends = np.cumsum(width)
        whole = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        place = np.arange(ends[-1]) - np.repeat(ends - width, width)
        symbols, odd, point, width = (np.repeat(x, width) for x in (symbols, odd, point, width))
        byte = np.where(place == 0, np.array([0, 0, 0xC0, 0xE0, 0xF0])[width], 0x80) | (point >> 6 * (width - 1 - place)) & np.where((place == 0), 0xFF, 0x3F)
        return np.where(odd, np.array(self.bytes)[byte], symbols).astype("<u4"), np.diff(whole)


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        import numpy as np

        self.held, self.n = np.empty(1024, kind), 0

    def add(self, values) -> None:
        import numpy as np

        end = self.n + len(values)
        if end > len(self.held):
            held = np.empty(max(end, 2 * len(self.held)), self.held.dtype)
            held[: self.n] = self.held[: self.n]
            self.held = held
        self.held[self.n : end] = values
        self.n = end


def _mixed(base, number):
    """A 64-bit hash of each base and number."""
    import numpy as np

    with np.errstate(over="ignore"):
        h = base ^ ((number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return h ^ (h >> np.uint64(31))


#: A part's place and size in the table of symbols, its ids, its candidates after the last skipped one, its children for each of those, the skipped ones as bits.
NODE = [("start", "i8"), ("first_id", "i8"), ("child", "i8"), ("skips", "u8", (2,)), ("size", "i4"), ("n_ids", "i4"), ("more", "i4"), ("last", "i4")]


def _alike(size):
    """Rows of parts of 1 to 32 characters in groups of like length, at most 8192 each, and the greatest length."""
    import numpy as np

    for low, high in ((0, 5), (5, 8), (8, 12), (12, 18), (18, SHORT)):
        rows = np.flatnonzero((size > low) & (size <= high))
        for a in range(0, len(rows), 8192):
            yield rows[a : a + 8192], high


class DropoutEncoder:
    """Ids of texts under one model, seed and rate."""

    def __init__(self, path: str, rate: float = DROPOUT, seed: int = SEED, streams: int | None = STREAMS, limit: int = CACHE_PARTS):
        self.pieces, self.rate, self.seed, self.limit = Pieces(path), rate, seed, limit
        self.least = int(rate * (1 << 32))
        self.streams = streams if self.least else 1
        self.caches: list[dict[str, bytes]] = [{} for _ in range(self.streams or 0)]
        if not self.streams:
            self._forget()

    def _forget(self) -> None:
        """Empties the tables of parts. A node is a part and the numbers, in its row of candidates, of those that are skipped."""
        self.roots: dict[str, int] = {}
        self.nodes = Grown(NODE)
        self.symbols, self.ids, self.children = Grown("i4"), Grown("<u4"), Grown("i4")

    def let_go(self) -> None:
        """Empties all tables of parts."""
        for cache in self.caches:
            cache.clear()
        if not self.streams:
            self._forget()

    def _add(self, start, size, skips, last):
        """Makes the nodes of parts (where their symbols start, and how many) with skipped candidates, the last of them apart; their numbers."""
        import numpy as np

        numbers = np.empty(len(start), np.int64)
        for rows, high in _alike(size):
            place = np.arange(high)[:, None]
            symbols = self.symbols.held[np.minimum(start[rows] + place, self.symbols.n - 1)]
            symbols[place >= size[rows]] = -1
            ids, counts, seen = self._in_step(symbols, skips=skips[rows])
            made = np.empty(len(rows), NODE)
            made["start"], made["size"], made["skips"], made["last"] = start[rows], size[rows], skips[rows], last[rows]
            made["n_ids"], made["more"] = counts, seen - last[rows] - 1
            for name, pool, n in (("first_id", self.ids, counts), ("child", self.children, made["more"])):
                made[name] = pool.n + np.cumsum(n) - n
            self.ids.add(ids)
            self.children.add(np.full(int(made["more"].sum()), -1, np.int32))
            numbers[rows] = self.nodes.n + np.arange(len(rows))
            self.nodes.add(made)
        return numbers

    def _learn(self, parts: list[str]) -> None:
        """Makes the nodes of new parts, with nothing skipped."""
        import numpy as np

        size = np.fromiter(map(len, parts), np.int64, len(parts))
        start = self.symbols.n + np.cumsum(size) - size
        self.symbols.add(self.pieces.symbols(parts))
        numbers = self._add(start, size, np.zeros((len(parts), 2), np.uint64), np.full(len(parts), -1))
        self.roots.update(zip(parts, numbers.tolist()))

    def _grow(self, node, taken):
        """Makes the nodes where, after so many further candidates of each node, one is skipped."""
        import numpy as np

        of = self.nodes.held[node]
        at, skips = of["last"] + 1 + taken, of["skips"]
        skips[np.arange(len(at)), at >> 6] |= np.uint64(1) << (at & 63).astype(np.uint64)
        return self._add(of["start"], of["size"], skips, at)

    def _varied(self, texts: list[str], keys: list) -> list[bytes]:
        """encode() with draws for every occurrence of a part.

        The number of candidates taken before the next skipped one is drawn at
        once, which is the same as drawing for each.
        """
        import numpy as np
        import xxhash

        if self.nodes.n > 2 * self.limit:
            self._forget()
        split = [self.pieces.parts.findall(" " + t) if t else [] for t in texts]
        parts = [p for row in split for p in row]
        node = np.fromiter(map(self.roots.get, parts, repeat(-1)), np.int64, len(parts))
        missing = np.flatnonzero(node < 0).tolist()
        if new := list({p for p in map(parts.__getitem__, missing) if len(p) <= SHORT}):
            self._learn(new)
            node[missing] = np.fromiter(map(self.roots.get, map(parts.__getitem__, missing), repeat(-1)), np.int64, len(missing))
        ends = np.cumsum([0, *map(len, split)])
        place = np.arange(len(parts)) - np.repeat(ends[:-1], np.diff(ends))
        document = np.array([xxhash.xxh3_64_intdigest(str(k), seed=self.seed) for k in keys], np.uint64)
        own = _mixed(np.repeat(document, np.diff(ends)), place)
        going, draw, keep = np.flatnonzero(node >= 0), 0, 1 - self.rate
        none = keep ** np.arange(SHORT + 1.0)  # that none of so many candidates is skipped
        while len(going):
            more = self.nodes.held["more"][node[going]]
            u = ((_mixed(own[going], np.full(len(going), draw)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            skip = u >= none[more]
            going, u, more = going[skip], u[skip], more[skip]
            taken = np.minimum(np.floor(np.log(u) / np.log(keep)).astype(np.int64), more - 1) if keep > 0 else np.zeros(len(going), np.int64)
            at = self.nodes.held["child"][node[going]] + taken
            if len(lack := np.flatnonzero(self.children.held[at] < 0)):
                slots, first = np.unique(at[lack], return_index=True)
                first = lack[first]
                # made first: the table of children grows with them
                made = self._grow(node[going[first]], taken[first])
                self.children.held[slots] = made
            node[going] = self.children.held[at]
            draw += 1
        of = self.nodes.held[["first_id", "n_ids"]][node]
        first, n, known = of["first_id"], of["n_ids"].astype(np.int64), self.ids.n
        for k in np.flatnonzero(node < 0).tolist():
            long = self.merge(parts[k], 0, int(own[k]))
            first[k], n[k] = self.ids.n, len(long)
            self.ids.add(long)
        to = np.concatenate([[0], np.cumsum(n)])
        whole = self.ids.held[np.repeat(first - to[:-1], n) + np.arange(to[-1])].tobytes()
        self.ids.n = known
        cuts = (4 * to[ends]).tolist()
        return [whole[a:b] for a, b in zip(cuts, cuts[1:])]

    def stream(self, key) -> int:
        """The stream of a document id."""
        import xxhash

        return xxhash.xxh3_64_intdigest(str(key), seed=self.seed) % self.streams

    def merge(self, part: str, stream: int, base: int | None = None) -> list[int]:
        """Ids of one part by agenda merging with keyed dropout, keyed by the stream and part or by `base`."""
        import xxhash

        least = self.least
        if base is None:
            base = xxhash.xxh3_64_intdigest(part, seed=self.seed + stream) if least else 0

        def skip(at, i, piece):
            h = ((base ^ (i * 0x9E3779B97F4A7C15 & MASK) ^ piece) * 0xD6E8FEB86659FD93) & MASK
            h = ((h ^ h >> 32) * 0xD6E8FEB86659FD93) & MASK
            return h >> 32 < least

        return self._agenda(part, skip if least else None)[0]

    def _agenda(self, part: str, skip=None) -> tuple[list[int], int]:
        """Ids of one part and the number of candidates; skip(number, place, piece) says whether one is skipped."""
        known, n, seen = self.pieces.known, len(part), 0
        symbols: list[str | None] = list(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            if (hit := known.get(part[i : i + 2])) is not None:
                agenda.append((hit[0], i, 2, hit[1]))
        heapify(agenda)
        while agenda:
            _, i, length, piece = heappop(agenda)
            left = symbols[i]
            if left is None or (j := after[i]) >= n or len(left) + len(symbols[j]) != length or known[left + symbols[j]][1] != piece:
                continue  # one of the two has been merged since
            seen += 1
            if skip and skip(seen - 1, i, piece):
                continue
            joined = symbols[i] = left + symbols[j]
            symbols[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (hit := known.get(joined + symbols[k])) is not None:
                    heappush(agenda, (hit[0], i, length + len(symbols[k]), hit[1]))
            if (k := before[i]) >= 0 and (hit := known.get(symbols[k] + joined)) is not None:
                heappush(agenda, (hit[0], k, length + len(symbols[k]), hit[1]))
        out = []
        for s in symbols:
            if s is not None:
                if (hit := known.get(s)) is not None:
                    out.append(hit[1])
                else:
                    out.extend(self.pieces.bytes[b] for b in s.encode())
        return out, seen

    def merge_all(self, parts: list[str], stream: int) -> list[bytes]:
        """What merge() gives for each part, as bytes, the agendas of many parts worked off in step.

        A row holds the symbols of a part and the ranks of its candidates; each
        step takes every row's best candidate, leftmost on ties.
        """
        import numpy as np
        import xxhash

        out: list[bytes] = [b""] * len(parts)
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        for rows, high in _alike(np.where(size > SHORT, 0, size)):
            some = [parts[r] for r in rows.tolist()]
            symbols = np.full((len(rows), high), -1, np.int32)
            symbols[np.arange(high) < size[rows][:, None]] = self.pieces.symbols(some)
            base = np.array([xxhash.xxh3_64_intdigest(p, seed=self.seed + stream) for p in some], np.uint64) if self.least else None
            ids, counts, _ = self._in_step(np.ascontiguousarray(symbols.T), base)
            whole, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            for r, a, b in zip(rows.tolist(), [0, *ends], ends):
                out[r] = whole[a:b]
        for r, part in enumerate(parts):
            if len(part) > SHORT:
                out[r] = array("I", self.merge(part, stream)).tobytes()
        return out

    def _in_step(self, symbols, base=None, skips=None):
        """Ids of columns of symbols (-1 after the last) one after the other, the number of ids and of candidates of each.

        Skipped are the candidates whose numbers are set in the column's skips, or those that the hash of its base says.
        Symbols stay at their places; each has those before and after it, and the last row stands for neither.
        """
        import numpy as np

        width, n = symbols.shape
        final, seen, column = np.empty((width, n), np.int32), np.zeros(n, np.int64), np.arange(n)
        symbols = np.concatenate([symbols, np.full((1, n), -1, np.int32)])
        after = np.repeat(np.arange(1, width + 2, dtype=np.int32), n).reshape(-1, n)
        before = after - 2
        after[width], before[0], before[width] = width, width, width
        best, piece = np.full((width + 1, n), NEVER, np.int32), np.full((width + 1, n), -1, np.int32)

        def set_candidates(at, place, of, left, right):
            """Which piece the symbols left and right make, and its rank and place, or NEVER if there is none or it is skipped."""
            made = self.pieces.joined(left, right)
            rank = np.where(made >= 0, self.pieces.rank[made] * 32 + place, NEVER)
            if base is not None:
                with np.errstate(over="ignore"):
                    h = (base[of] ^ (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.maximum(made, 0).astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
                    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
                rank[(h >> np.uint64(32)) < self.least] = NEVER
            best.ravel()[at], piece.ravel()[at] = rank, made

        at = np.flatnonzero(symbols[1:].ravel() >= 0)
        set_candidates(at, at // n, at % n, symbols.ravel()[at], symbols.ravel()[at + n])
        step = 0
        while True:
            least = best[:width].min(axis=0)
            going = np.flatnonzero(least < NEVER)
            if len(going) < 0.75 * n or not len(going):
                # the others have ended
                ended = np.flatnonzero(least == NEVER)
                final[:, column[ended]] = symbols[:width, ended]
                if not len(going):
                    break
                symbols, after, before, best, piece = (x.take(going, axis=1) for x in (symbols, after, before, best, piece))
                column, n, least, going = column[going], len(going), least[going], np.arange(len(going))
            else:
                least = least[going]
            seen[column[going]] += 1
            place = least & 31
            at = place.astype(np.int64) * n + going
            if skips is not None:
                skipped = (skips[column[going], step >> 6] >> np.uint64(step & 63) & np.uint64(1)).astype(bool)
                best.ravel()[at[skipped]] = NEVER
                going, place, at = going[~skipped], place[~skipped], at[~skipped]
            step += 1
            made = piece.ravel()[at]
            gone = after.ravel()[at].astype(np.int64) * n + going
            right = after.ravel()[gone]
            right_at = right.astype(np.int64) * n + going
            left = before.ravel()[at]
            left_at = left.astype(np.int64) * n + going
            symbols.ravel()[at], symbols.ravel()[gone], best.ravel()[gone] = made, -1, NEVER
            after.ravel()[at], before.ravel()[right_at] = right, place
            # the pair with the symbol after, and that with the symbol before
            set_candidates(
                np.concatenate([at, left_at]), np.concatenate([place, left]), np.tile(column[going], 2),
                np.concatenate([made, symbols.ravel()[left_at]]), np.concatenate([symbols.ravel()[right_at], made]),
            )
        final = final.T
        filled = final >= 0
        ids, counts = self.pieces.spelled_out(final[filled], filled.sum(axis=1))
        return ids, counts, seen

    def encode(self, texts: list[str], keys: list) -> list[bytes]:
        """For each text its ids as little-endian 32-bit integers."""
        if not self.streams:
            return self._varied(texts, keys)
        split = [self.pieces.parts.findall(" " + t) if t else [] for t in texts]
        streams = [self.stream(k) for k in keys]
        for s, cache in enumerate(self.caches):
            used: set[str] = set()
            for parts, of in zip(split, streams):
                if of == s:
                    used.update(parts)
            new = [p for p in used - cache.keys() if len(p) <= SHORT]
            if len(cache) + len(new) > self.limit:
                cache.clear()
                new = [p for p in used if len(p) <= SHORT]
            for a in range(0, len(new), 8192):
                cache.update(zip(new[a : a + 8192], self.merge_all(new[a : a + 8192], s)))
        # long parts are merged where they occur and not kept
        return [b"".join(self.caches[s].get(p) or array("I", self.merge(p, s)).tobytes() for p in parts) for parts, s in zip(split, streams)]

    def decode(self, ids) -> str:
        return b"".join(map(self.pieces.spelled.__getitem__, ids)).decode("utf-8")[1:]


_ENCODERS: dict[tuple, DropoutEncoder] = {}


def _shared(*how) -> DropoutEncoder:
    """The worker's own encoder, which keeps the model's tables from task to task."""
    if how not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[how] = DropoutEncoder(*how)
    return _ENCODERS[how]


#: What encode() adds: ids, their crc32, whether decoding gave the text, and the ids themselves.
ADDED = ("__n", "__crc", "__same", "__ids")


def _encode(how: tuple, more: list[str], text: str, key: str, added: list[str]):
    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        encoder = _shared(*how)
        for batch in batches:
            texts, keys = batch.column(text).to_pylist(), batch.column(key).to_pylist()
            # the ids of a batch are emitted in slices, so that long texts do not meet in one array
            for a in range(0, len(texts), TEXTS):
                n, crc, same, ids = [], [], [], []
                for one, coded in zip(texts[a : a + TEXTS], encoder.encode(texts[a : a + TEXTS], keys[a : a + TEXTS])):
                    row = np.frombuffer(coded, "<u4")
                    n.append(len(row))
                    crc.append(zlib.crc32(coded))
                    same.append(encoder.decode(row.tolist()) == one)
                    if len(added) > 3:
                        ids.append(row.astype("<i4"))
                part = batch.slice(a, TEXTS)
                columns = [*[part.column(c) for c in more], pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())]
                if len(added) > 3:
                    offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, "<i4"))))
                yield pa.RecordBatch.from_arrays(columns, [*more, *added])
        encoder.let_go()  # the worker has other things to hold

    return run


def encode(
    df: DataFrame, model: str, text: str = "text", key: str = "doc_id", rate: float = DROPOUT, seed: int = SEED, streams: int | None = STREAMS, with_ids: bool = True, names: tuple[str, ...] = ADDED
) -> DataFrame:
    """df with the number of ids, the crc32 of the ids as 32-bit integers, whether decoding gave the text and, if wanted, the ids.

    model: path of a model file that exists on every machine. names: of the new
    columns; where df has one of them already, an underscore is added.
    """
    added = unused(df.columns, *names)[: 4 if with_ids else 3]
    kinds = (T.LongType(), T.LongType(), T.BooleanType(), T.ArrayType(T.IntegerType()))
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, t) for n, t in zip(added, kinds)]])
    held, keyed = unused([*df.columns, *added], "__text", "__key")
    rows = df.select(*quoted(df.columns), text_or_empty(text).alias(held), F.col(key).cast("string").alias(keyed))
    return rows.mapInArrow(_encode((model, rate, seed, streams), df.columns, held, keyed, added), schema)


def decode(df: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """df with a column __decoded, or one underscore more."""
    name, = unused(df.columns, "__decoded")

    def run(batches: Iterator):
        import pyarrow as pa

        encoder = _shared(model, 0.0, 0, 1)
        for batch in batches:
            texts = [encoder.decode(row or []) for row in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(name, T.StringType())]))


def piece_digests(df: DataFrame, model: str, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, lossless for every row of df."""
    out = encode(df.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), model, with_ids=False, **options)
    return out.select("doc_id", F.col("__n").alias("n_pieces"), F.col("__crc").alias("ids_crc32"), F.col("__same").alias("lossless"))
