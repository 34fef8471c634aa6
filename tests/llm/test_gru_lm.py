import collections
import math
import re
import zlib
from types import SimpleNamespace

import numpy as np
import pytest

from surveyspark.llm import gru_lm as G


def fake_vocabulary(seed=0):
    rng = np.random.default_rng(seed)
    return SimpleNamespace(short_n=rng.integers(1, 50, G.SHORTLIST).astype(float),
                           shape_n=np.ones(G.SHAPES) * 40, shape_v=np.ones(G.SHAPES) * 10)


@pytest.fixture
def parameters():
    p = {k: v.astype(np.float64) for k, v in G.new_parameters(fake_vocabulary()).items()}
    p["w"] = np.random.default_rng(1).standard_normal(p["w"].shape) * 0.1
    return p


def test_gradients_against_differences(parameters):
    rng = np.random.default_rng(2)
    symbols, mask = rng.integers(0, G.SHORTLIST + G.SHAPES, (3, 6)), np.ones((3, 6), bool)
    mask[2, 4:] = False

    def loss(p):
        h, total = np.zeros((3, G.HIDDEN)), 0
        for t in range(6):
            logp, _ = G._output(p, h, symbols[:, t])
            total -= logp[mask[:, t]].sum()
            h = G._step(p, symbols[:, t], h)[0]
        return total

    trainer = G.Trainer({k: v.copy() for k, v in parameters.items()}, 1.0)
    trainer.window(symbols, mask, np.zeros((3, G.HIDDEN)))
    ratios = []
    for name, first in trainer.m.items():  # the first moment is a fixed share of the gradient
        at = np.argwhere(np.abs(first) > 1e-5)
        for i in map(tuple, at[::max(1, len(at) // 4)][:4]):
            moved = {k: v.copy() for k, v in parameters.items()}
            moved[name][i] += 1e-5
            up = loss(moved)
            moved[name][i] -= 2e-5
            ratios.append((up - loss(moved)) / 2e-5 / first[i])
    assert len(ratios) >= 20 and np.ptp(ratios) < 1e-2 * np.mean(ratios)


def test_probabilities_sum_to_one_and_state_is_carried(parameters):
    h = np.random.default_rng(3).standard_normal((1, G.HIDDEN))
    every = np.arange(G.SHORTLIST + G.SHAPES)
    logp, _ = G._output(parameters, np.repeat(h, len(every), axis=0), every)
    assert abs(np.exp(logp).sum() - 1) < 1e-6
    p = {k: v.astype(np.float32) for k, v in parameters.items()}
    rng = np.random.default_rng(4)
    sizes = np.array([1, 100, 33, 0, 32, 64, 5])
    at = np.append(0, np.cumsum(sizes))
    symbols = rng.integers(0, G.SHORTLIST + G.SHAPES, at[-1])
    got = G.score_texts(p, symbols, at)
    for k in range(len(sizes)):
        state, total = np.zeros((1, G.HIDDEN), np.float32), 0.0
        for s in symbols[at[k]:at[k + 1]]:
            total += G._output(p, state, np.array([s]))[0][0]
            state = G._step(p, np.array([s]), state)[0]
        assert abs(got[k] - total) < 1e-3 * max(1, abs(total))


def brute(rows):
    texts = [(i, [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())] + [None]) for i, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    count = collections.Counter(w for (_, t), out in zip(texts, held) if not out for w in t)
    total, distinct = sum(count.values()), len(count)
    return sorted([(str(i), out, len(t), sum(count[w] > 0 for w in t), total,
                    round(sum(math.log10((count[w] + 1) / (total + distinct + 1)) for w in t), 6))
                   for (i, t), out in zip(texts, held)], key=str)


def result(df):
    return sorted([(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0)
                   for r in df.collect()], key=str)


def test_base_score_equals_brute_force(documents, prose, monkeypatch):
    rows = [(k, prose(k, 3 + k % 90)) for k in range(120)] + [
        (500, None), (501, ""), (502, "Ba BA é É"), (503, prose(7, 3000)), (None, "ba ko"), (7, prose(7, 10))]
    assert result(G.score_documents(documents(rows))) == brute(rows)
    monkeypatch.setattr(G, "HEAD", 40)  # most words are joined, not looked up
    assert result(G.score_documents(documents(rows))) == brute(rows)


def test_no_rows_and_no_training_rows(documents):
    assert G.score_documents(documents([])).count() == 0
    held = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    row = G.score_documents(documents([(held, "a b")])).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
    assert row.score < 0


def test_model_learns_what_follows_what(documents):
    """Words of two alphabets never mix in a text: the state tells which one it is."""
    rng = np.random.default_rng(5)
    words = [[f"{c}{k}" for k in range(40)] for c in "ab"]
    rows = [(k, " ".join(rng.choice(words[k % 2], 40))) for k in range(700)]
    got = G.score_documents(documents(rows)).collect()
    held = [r for r in got if r.held_out]
    assert len(held) > 60
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.1  # of the 0.3 there are to gain for each word


def test_every_training_document_is_learned_from(documents, monkeypatch):
    docs = documents([(k, f"a{k % 7} b{k}") for k in range(4000)])
    kind, seen = type(docs), []
    plain = kind.mapInArrow

    def spy(self, func, schema, *more, **named):
        if schema == "n double, p binary":
            seen.append(self.count())
        return plain(self, func, schema, *more, **named)

    monkeypatch.setattr(kind, "mapInArrow", spy)
    G.score_documents(docs)
    learned = sum(zlib.crc32(str(k).encode()) % 7 != 2 for k in range(4000))
    assert sum(seen) == learned and min(seen) > 0.3 * learned
