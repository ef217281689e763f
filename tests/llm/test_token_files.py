import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from colloquy.llm import token_files as T

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


@settings(deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=300), st.sampled_from(["bit", "byte"]))
def test_planes_go_there_and_back(ids, kind):
    x = np.array(ids, "<u4")
    assert (T.join_planes(T.split_planes(x, 4, kind), len(x), 4, kind) == x).all()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_a_file_by_blocks_and_by_documents(tmp_path, kind):
    rnd = random.Random(3)
    docs = [(k if k % 7 else None, np.array([rnd.randint(0, 49407) for _ in range(rnd.choice([0, 1, 40, 900]))], "<u4")) for k in range(60)]
    T.write_whole(f"file://{tmp_path}/x.ids", T.file_parts(docs, 2, kind, block=128))
    source = T.IdFile(f"file://{tmp_path}/x.ids")
    whole = np.concatenate([d for _, d in docs])
    assert (source.block(3) == whole[384:512]).all()
    got = [(k, np.concatenate(p) if p else np.zeros(0, "<u4")) for k, p in source.docs()]
    assert [k for k, _ in got] == [k for k, _ in docs] and all((a == b).all() for (_, a), (_, b) in zip(got, docs))
    source.close()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abAZ'stredvml 01.,!-\n\t\r\x0b\x0céÉßª²½Σςİıﬁ你́\x85\xa0\x1c\x00 <|>"), max_size=30))
def test_words_give_the_library_s_ids(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(T.WordEncoder.shared(PATH).encode([text])[0], "<u4").tolist() == want


def test_special_tokens_in_texts():
    text = "a<|endoftext|>b"
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(T.WordEncoder.shared(PATH).encode([text])[0], "<u4").tolist() == want


def test_files_of_awkward_rows(awkward, awkward_rows, empty):
    got = T.read_token_files(T.write_token_files(awkward, PATH, file_bytes=2000)).collect()
    want = [(r[0], LIBRARY.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in awkward_rows]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(((k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in want), key=str)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert T.read_token_files(T.write_token_files(empty, PATH)).collect() == []


def test_runs_met_before_are_not_split_again(monkeypatch):
    encoder = T.WordEncoder(PATH)
    texts = ["Don't stop, it's a's,b''s '''s!'d 12.5%; ÉTÉ's\xa0Ñandú³\x0bx", "over\tthe\r\nhills ... it's"]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(c, "<u4").tolist() for c in encoder.encode(texts)] == want
    monkeypatch.setattr(T, "WORDS", None)
    assert [np.frombuffer(c, "<u4").tolist() for c in encoder.encode(texts)] == want


def test_tables_that_are_full_and_runs_that_are_too_long_to_keep():
    encoder, rnd = T.WordEncoder(PATH, limit=20), random.Random(9)
    texts = [" ".join("".join(rnd.choices("abcé1.,'s你", k=rnd.choice([1, 3, 9, 700]))) for _ in range(8)) for _ in range(60)]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(c, "<u4").tolist() for c in encoder.encode(texts)] == want
    assert len(encoder.words) < 2000 and max(map(len, encoder.words)) <= T.LONGEST_RUN
    assert encoder.words.characters == sum(map(len, encoder.words))
