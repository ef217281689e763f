import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from colloquy.llm import sentencepieces as P

from llm_fixtures import prose

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PLAIN, DROPPED = P.DropoutEncoder(PATH, 0.0), P.DropoutEncoder(PATH, 0.3, streams=4)
TEXT = st.text(st.sampled_from(list("abcing the.,;:!?()[]{}<>|_-'\"/\\$#@*&%+=~^`\n\t\r0123éß你\U0001f600①\x00")), max_size=40)


def ids(encoder, text, key=0):
    return np.frombuffer(encoder.encode([text], [key])[0], "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_without_dropout_ids_are_the_library_s(text):
    assert ids(PLAIN, text) == LIBRARY.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40), st.integers(0, 9))
def test_every_segmentation_decodes_to_the_text(text, key):
    text = text.encode("utf-8", "ignore").decode()
    assert DROPPED.decode(ids(DROPPED, text, key)) == text


def slow_merge(encoder, part, stream):
    """Merging by scanning all neighbours for the best candidate that is not skipped."""
    import xxhash

    known, base, mask = encoder.pieces.known, xxhash.xxh3_64_intdigest(part, seed=encoder.seed + stream), (1 << 64) - 1
    symbols, places = list(part), list(range(len(part)))
    while True:
        best = None
        for k in range(len(symbols) - 1):
            hit = known.get(symbols[k] + symbols[k + 1])
            if hit:
                h = ((base ^ (places[k] * 0x9E3779B97F4A7C15 & mask) ^ hit[1]) * 0xD6E8FEB86659FD93) & mask
                h = ((h ^ h >> 32) * 0xD6E8FEB86659FD93) & mask
                if h >> 32 >= encoder.least and (best is None or hit[0] < best[0]):
                    best = (hit[0], k)
        if best is None:
            break
        k = best[1]
        symbols[k : k + 2], places[k : k + 2] = [symbols[k] + symbols[k + 1]], [places[k]]
    return [i for s in symbols for i in ([known[s][1]] if s in known else [encoder.pieces.bytes[b] for b in s.encode()])]


def test_agendas_in_step_alone_and_by_scanning_agree():
    parts = sorted({p for s in range(40) for p in DROPPED.pieces.parts.findall(" " + prose(s, 50) + " don't ()[] xé你 " + "long" * 20)})
    for stream in (0, 3):
        for part, coded in zip(parts, DROPPED.merge_all(parts, stream)):
            want = slow_merge(DROPPED, part, stream)
            assert np.frombuffer(coded, "<u4").tolist() == DROPPED.merge(part, stream) == want


def test_dropout_varies_with_stream_and_seed_and_stays_with_the_key():
    text = prose(1, 200)
    assert ids(DROPPED, text, 1) == ids(P.DropoutEncoder(PATH, 0.3, streams=4), text, 1)
    assert len({tuple(ids(DROPPED, text, k)) for k in range(20)}) == 4
    assert ids(P.DropoutEncoder(PATH, 0.3, seed=1), text, 1) != ids(P.DropoutEncoder(PATH, 0.3, seed=2), text, 1)
    assert len(ids(DROPPED, text)) > len(ids(PLAIN, text))


def test_awkward_rows(awkward, awkward_rows, empty):
    out = P.encode(awkward, PATH)
    n, crc, same, coded = out.columns[-4:]
    assert out.columns[:-4] == awkward.columns and (n, crc, same, coded) == ("__n_", "__crc", "__same", "__ids_")
    back = P.decode(out, PATH, coded).collect()
    assert sorted(r["__decoded"] for r in back) == sorted(r[1] or "" for r in awkward_rows)
    assert all(r[same] and r[n] == len(r[coded]) and r["__n"] == f"own {r.doc_id}" for r in back)
    assert P.piece_digests(empty, PATH).collect() == []


def test_every_occurrence_of_a_word_is_cut_for_itself():
    encoder = P.DropoutEncoder(PATH, 0.3)
    word, n = "internationalization", 400
    within = encoder.encode([" ".join([word] * n)], [1])[0]
    assert encoder.decode(np.frombuffer(within, "<u4").tolist()) == " ".join([word] * n)
    alone = [ids(encoder, word, k) for k in range(n)]
    assert len({tuple(x) for x in alone}) > 10
    assert [ids(P.DropoutEncoder(PATH, 0.3), word, k) for k in range(3)] == alone[:3]
    assert len(within) // 4 > 1.2 * n * len(ids(PLAIN, word))


def test_segmentations_are_as_frequent_as_with_a_draw_for_each_candidate():
    import random
    from collections import Counter

    encoder, rnd, n = P.DropoutEncoder(PATH, 0.1), random.Random(5), 6000
    for word in ("the", "orchard", "internationalization"):
        got = Counter(tuple(ids(encoder, word, k)) for k in range(n))
        want = Counter(tuple(encoder.merge(" " + word, 0, rnd.getrandbits(64))) for _ in range(n))
        assert all(abs(got[x] - want[x]) < 0.03 * n for x in got | want)


def test_short_parts_of_any_characters_are_worked_off_in_step(monkeypatch):
    import math

    import xxhash

    rate, keep = 0.3, 1 - 0.3
    encoder = P.DropoutEncoder(PATH, rate)
    texts = ["\nThedhely $$$ xé你\U0001f600 orchards%%%\x00", prose(7, 60), ""]

    def with_draws_one_by_one(text, key):
        document, out = np.array([xxhash.xxh3_64_intdigest(str(key), seed=encoder.seed)], np.uint64), []
        for place, part in enumerate(encoder.pieces.parts.findall(" " + text) if text else []):
            own, skipped, at = P._mixed(document, np.array([place])), set(), -1
            for draw in range(40):
                u = (int(P._mixed(own, np.array([draw]))[0] >> np.uint64(11)) + 0.5) * 2.0**-53
                at += 1 + math.floor(math.log(u) / math.log(keep))
                skipped.add(at)
            out += encoder._agenda(part, lambda number, i, piece: number in skipped)[0]
        return out

    want = [[with_draws_one_by_one(t, k) for t in texts] for k in range(30)]

    def slow(*_):
        raise AssertionError("a short part was merged alone")

    monkeypatch.setattr(P.DropoutEncoder, "_agenda", slow)
    assert [[ids(encoder, t, k) for t in texts] for k in range(30)] == want
