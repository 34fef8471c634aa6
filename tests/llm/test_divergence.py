import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surveyspark.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(word):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in word)


def brute(rows):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = [lower(w) for w in TERM.findall(text or "")]
        docs[lang].update(set(words))
        counts[lang, source].update(words)
        groups.add((lang, source))
    out = []

    def ranked(lang, source, part, found, most):
        best = sorted(found, key=lambda x: (-x[1], x[0].encode()))
        out.extend((lang, source, part, item, v, k) for k, (item, v) in enumerate(best[:most], 1))

    for lang in {g[0] for g in groups}:
        kept = [w for w, n in docs[lang].items() if n >= 3]
        sources = [s for v, s in groups if v == lang]

        def shares(c):
            total = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 1) // (total + len(kept)) for w in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            ranked(lang, s, "pair", [(o, sum((p[s][w] - p[o][w]) ** 2 // p[o][w] for w in kept))
                                     for o in sources if o != s], None)
            ranked(lang, s, "term", [(w, (p[s][w] - q[w]) ** 2 // q[w]) for w in kept
                                     if counts[lang, s][w] and p[s][w] > q[w]], 200)
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(k, t, v, s, 1, "x", 2) for k, (t, v, s) in enumerate(rows)],
        "doc_id long, text string, lang string, source string, n long, term string, p long").repartition(4)


def got(spark, rows):
    return [tuple(r) for r in divergence.divergences(frame(spark, rows)).collect()]


@pytest.mark.parametrize("shard,held,pairs", [(1 << 23, 1 << 20, 1 << 18), (300, 40, 3)])
def test_equals_a_plain_count(spark, monkeypatch, shard, held, pairs):
    rnd = random.Random(3)
    words = ["a", "aB", "abcdefgh", "abcdefgH", "abcdefghi", "abcdefghijklmnopq", "abcdefghijklmnopqr", "é", "É", "日本語",
             "ß x", "zz"] + ["w" + "".join(rnd.choice("abc") for _ in range(k % 7 + 1)) for k in range(60)]
    rows = [(rnd.choice([" ", "1", "\n", "_", "\0"]).join(rnd.choice(words) for _ in range(rnd.randrange(30))),
             rnd.choice(["en", "en", "fr", None]), rnd.choice(["s1", "s1", "s2", "š", None])) for _ in range(150)]
    rows += [(None, "en", "s1"), (None, "de", "s1"), ("", "de", "s2"), ("lone words here", "xx", "s")] + [rows[0]] * 5
    rows += [(" ".join(rnd.choice(words) for _ in range(20000)), "en", "long")]
    monkeypatch.setattr(divergence, "SHARD", shard)
    monkeypatch.setattr(divergence, "HELD", held)
    monkeypatch.setattr(divergence, "PAIRS", pairs)
    if shard < 1000:  # in this process, as a task would run it
        batches = pa.Table.from_pydict({c: [r[i] or "" for r in rows] for i, c in enumerate(("text", "lang", "source"))})
        total = Counter()
        for b in divergence.count_terms(iter(batches.to_batches(max_chunksize=7))):
            for r in b.to_pylist():
                total[r["lang"], r["source"], r["term"], "n"] += r["n"]
                total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
        want = Counter()
        for t, v, s in rows:
            found = [lower(w) for w in TERM.findall(t or "")]
            for w, n in Counter(found).items():
                want[v or "", s or "", w, "n"] += n
                want[v or "", s or "", w, "docs"] += 1
        assert total == want
    else:
        assert sorted(got(spark, rows)) == sorted(brute(rows))


def test_shared_terms_in_small_blocks(monkeypatch):
    rnd = random.Random(5)
    rows = [(v, s, w, rnd.randrange(1, 10**9), {"s1": 3, "s2": 5, "s3": 9}[s])
            for v in ("en", "fr") for w in ("a", "b", "c", "d") for s in ("s1", "s2", "s3") if rnd.random() < 0.8]
    names = ["lang", "source", "term", "p", "p0"]

    def total(size, pairs):
        monkeypatch.setattr(divergence, "PAIRS", pairs)
        t = pa.table({n: [r[i] for r in rows] for i, n in enumerate(names)})
        out = Counter()
        for b in divergence.shared_terms(iter(t.to_batches(max_chunksize=size))):
            for r in b.to_pylist():
                out[r["lang"], r["source"], r["item"]] += r["value"]
        return out

    want = Counter()
    for v, s, w, p, p0 in rows:
        for v2, s2, w2, q, q0 in rows:
            if v == v2 and w == w2 and s != s2:
                want[v, s, s2] += (p - q)**2 // q - (p - q0)**2 // q0 - (p0 - q)**2 // q + (p0 - q0)**2 // q0
    assert total(100, 1 << 18) == total(1, 2) == total(3, 1) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=30), max_size=40))
def test_pointer_sort(words):
    raw = " ".join(words).encode()
    start, end = divergence.pointers(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    padded = np.append(np.frombuffer(raw, np.uint8), np.zeros(8, np.uint8))
    if not len(start):
        return
    order, first = divergence.sort_pointers(padded, start, end)
    got = [raw[a:b] for a, b in zip(start[order], end[order])]
    plain = sorted(range(len(words)), key=lambda i: (words[i].encode(), i))
    assert order.tolist() == plain
    assert first.tolist() == [i == 0 or got[i] != got[i - 1] for i in range(len(got))]


def test_empty_table_and_one_source(spark):
    assert got(spark, []) == []
    rows = [("alpha beta", "en", "only")] * 4
    assert got(spark, rows) == []
    assert sorted(got(spark, rows + [(None, "en", "other")])) == sorted(brute(rows + [(None, "en", "other")]))
