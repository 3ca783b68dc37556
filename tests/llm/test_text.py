import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm._text import ALNUM, SPACED, HashTable, shingles, split_words

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TEXT = st.text(st.sampled_from("aB 1.é\n\x00\x0bZ中x,-"), max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6), st.sampled_from([1, 7, 1000]))
def test_words_and_hashes_follow_the_patterns(texts, cut):
    seen = {}
    for table, pattern in ((SPACED, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        want = [re.findall(pattern, (t or "").translate(LOW)) for t in texts]
        got = []
        for w in split_words(pa.array(texts, pa.string()), table, max_bytes=cut):
            words, offs = w.words(), w.offsets()
            for a, h in zip(words, w.hashes().tolist()):
                assert seen.setdefault(a, h) == h
            got += [[x.replace(b"\xff", b"\0").decode() for x in words[offs[i]:offs[i + 1]]] for i in range(len(w.counts))]
        assert got == want
    assert len(set(seen.values())) == len(seen)


def test_word_longer_than_a_piece_hashes_whole():
    a, b = "x" * 600_000 + "a", "x" * 600_000 + "b"
    (w,) = split_words(pa.array([f"{a} {b} {a}"]), SPACED)
    h = w.hashes()
    assert h[0] == h[2] != h[1]


def test_shingles_of_short_texts_are_their_whole_sequence():
    (w,) = split_words(pa.array(["a b c d e", "a b", "", "a b", "b a"]), SPACED)
    sh, per = shingles(w.hashes(), w.counts, 4)
    assert per.tolist() == [2, 1, 0, 1, 1]
    assert sh[2] == sh[3] != sh[4]


def test_hash_table_finds_exactly_its_keys():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64))
    t = HashTable(keys[::2])
    assert (t.find(keys[::2]) == np.arange(len(keys[::2]))).all()
    assert (t.find(keys[1::2]) == -1).all()
    assert (HashTable(keys[:0]).find(keys) == -1).all()
