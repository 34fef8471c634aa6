import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surveyspark.llm import words as W
from surveyspark.llm.queries import VOCABULARY
from surveyspark.llm.tokens import Encoder

text = st.text(alphabet="aBcéÉ \t\n\x0b\x0c\r\x1c\x85 .,", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), text), max_size=8), st.integers(1, 30))
def test_words_are_those_of_a_plain_split(rows, limit):
    hashes, at, start, end = W.words(pa.array(rows, pa.string()), limit=limit, spans=True)
    raw = "".join(r or "" for r in rows).encode()
    seen = {}
    for i, r in enumerate(rows):
        want = [w for w in re.split(rb"[\x20\x09-\x0d]+", (r or "").encode()) if w]
        assert [raw[a:b] for a, b in zip(start[at[i]:at[i + 1]], end[at[i]:at[i + 1]])] == want
        for w, h in zip(want, hashes[at[i]:at[i + 1]].tolist()):
            assert seen.setdefault(w.lower(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_bare_words_and_shingles():
    a, _ = W.words(pa.array(['("Hello," -- world!)']), bare=True)
    b, _ = W.words(pa.array(["hello - world"]), bare=True)
    assert a[0] == b[0] and a[2] == b[2]
    h = np.arange(1, 8, dtype=np.uint64)
    assert len(W.shingles(h, 4)) == 4 and len(W.shingles(h[:2], 4)) == 1 and len(W.shingles(h[:0], 4)) == 0
    assert W.shingles(h[2:], 4)[0] == W.shingles(h, 4)[2]


plain = st.text(alphabet="ab éß1²\n\t\r\x1c\x85 .,'!?st<|>中’½", max_size=40)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


def test_token_ids_are_the_library_s(library):
    @settings(max_examples=300, deadline=None)
    @given(st.lists(plain, max_size=6))
    def check(rows):
        got = Encoder(VOCABULARY).encode(pa.array(rows, pa.large_string()))
        assert [list(g) for g in got] == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]

    check()


def test_special_strings_are_ordinary_text(library):
    rows = ["<|endoftext|>", "it's we'll", "", "  two", "end \n"]
    got = Encoder(VOCABULARY).encode(pa.array(rows, pa.large_string()))
    assert [list(g) for g in got] == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]
    assert 50256 not in got[0]
