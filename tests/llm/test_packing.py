import math
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from surveyspark.llm import packing
from surveyspark.llm.packing import cut, pack_documents, sum_of_squares
from surveyspark.llm.queries import VOCABULARY


def plain_rule(lengths, size):
    """Every open bin tried, the squares counted anew."""
    bins, out = [], []
    for x in lengths:
        best = None
        for k, g in [*enumerate(bins), (len(bins), size)]:
            if g < x:
                continue
            after = [*bins, size] if k == len(bins) else list(bins)
            after[k] = g - x
            counts = np.bincount([v for v in after if 0 < v < size] or [0], minlength=1)
            cost = int((counts[1:] ** 2).sum())
            if best is None or (cost, g) < best[:2]:
                best = (cost, g, k)
        k = best[2]
        if k == len(bins):
            bins.append(size)
        bins[k] -= x
        out.append(k)
    return out, bins


@pytest.mark.parametrize("seed", range(6))
def test_sum_of_squares_rule(seed):
    rnd = np.random.default_rng(seed)
    size = int(rnd.integers(5, 30))
    lengths = rnd.integers(1, size + 1, 60)
    got = sum_of_squares(lengths, size)
    left = size - np.bincount(got, weights=lengths)
    want, bins = plain_rule(lengths, size)
    assert (left >= 0).all()
    assert sorted(left.astype(int).tolist()) == sorted(bins)  # same bins, whatever their numbers


def test_pieces():
    assert cut(1, 8) == [(0, 1)] and cut(8, 8) == [(0, 8)] and cut(9, 8) == [(0, 1), (1, 8)]
    assert cut(24, 8) == [(0, 8), (8, 8), (16, 8)]


def check(rows, got, size=2048, end_id=0):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    bins, pieces = {}, {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end_id], "<u4")
        own = sorted(pieces[doc], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in own] == cut(len(ids), size)
        assert [r.piece for r in own] == list(range(len(own)))
        for r in own:
            assert r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    return len(bins)


def test_round_trip_and_fill(documents, prose):
    rows = [(k, prose(k, 5 + 37 * k % 900)) for k in range(300)]
    rows += [(900, None), (901, ""), (902, prose(1, 6000)), (903, "it's <|endoftext|> ’quoted’")]
    got = pack_documents(documents(rows), VOCABULARY).collect()
    used = check(rows, got)
    assert used <= math.ceil(sum(r.length for r in got) / 2048) + 2


def test_several_shards_and_rounds(documents, prose, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 20)
    rows = [(k, prose(k, 5 + 37 * k % 300)) for k in range(250)]
    got = pack_documents(documents(rows), VOCABULARY, size=256).collect()
    used = check(rows, got, size=256)
    assert used <= 1.03 * sum(r.length for r in got) / 256 + 1


def test_null_and_repeated_ids_and_no_rows(documents):
    got = pack_documents(documents([(None, "a"), (None, None), (4, "b"), (4, "b")]), VOCABULARY).collect()
    assert sorted((r.doc_id is None, r.length) for r in got) == [(False, 2), (False, 2), (True, 1), (True, 2)]
    assert sorted(r.offset for r in got) == [0, 2, 4, 6]
    assert pack_documents(documents([]), VOCABULARY).count() == 0
