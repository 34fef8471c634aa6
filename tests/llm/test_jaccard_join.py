import random
import re
from collections import Counter

import numpy as np
import pytest

from surveyspark.llm.components import components
from surveyspark.llm import jaccard_join as J
from surveyspark.llm.jaccard_join import jaccard_join, light_boundary, need, one_of_each_group, subset_sizes
from surveyspark.llm.scratch import Scratch


def brute(rows, width=4, percent=85):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(rb"[ \t\n\x0b\x0c\r]+", (t or "").encode().lower()) if x]
        sets[i] = frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j] and \
                    100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def edited(text, seed, changes):
    words, rnd = text.split(), random.Random(seed)
    for _ in range(changes):
        words[rnd.randrange(len(words))] = f"x{rnd.randrange(999)}"
    return " ".join(words)


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force_on_copies_chains_and_short_texts(documents, prose):
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "one two three four five"),
            (6, "É one two"), (7, "é one two")]
    for k in range(12):  # light sets of every size, with a word changed at an end
        text = prose(k, 6 + k)
        rows += [(100 + 10 * k, text), (101 + 10 * k, text + " more"), (102 + 10 * k, "less " + text),
                 (103 + 10 * k, text.upper())]
    for k in range(4):   # heavy sets: a chain of growing edits, and copies
        text, chain = prose(50 + k, 150), 1000 + 100 * k
        rows.append((chain, text))
        for step in range(6):
            text = edited(text, 7 * k + step, 2)
            rows.append((chain + 1 + step, text))
    common = prose(99, 40)  # a passage that dissimilar documents share
    rows += [(5000 + k, prose(200 + k, 60) + " " + common) for k in range(30)]
    random.Random(1).shuffle(rows)
    assert found(jaccard_join(documents(rows))) == brute(rows)


def test_large_group_of_near_copies_is_one_component(documents, prose):
    text = prose(1, 120)
    rows = [(k, edited(text, k, 1)) for k in range(400)] + [(1000 + k, text) for k in range(200)]
    got = found(jaccard_join(documents(rows)))
    assert got == brute(rows)


def test_null_ids_repeated_rows_and_empty_table(documents, prose):
    text = prose(3, 50)
    rows = [(None, text), (9, text), (9, text), (None, None), (8, text + " end")]
    got = sorted(map(tuple, jaccard_join(documents(rows)).collect()), key=str)
    size = len(text.split()) - 3
    assert got == sorted([(None, size, 8), (9, size, 8), (9, size, 8), (None, 0, None), (8, size + 1, 8)], key=str)
    assert jaccard_join(documents([])).count() == 0


def test_one_document_of_each_group_stays_whole(documents, prose):
    text = prose(4, 200)
    rows = [(5, text), (2, edited(text, 1, 2)), (7, prose(5, 200)), (8, None), (9, "")]
    kept = one_of_each_group(documents(rows))
    assert kept.columns == documents([]).columns
    assert {r.doc_id: r.text for r in kept.collect()} == {i: t for i, t in rows if i != 5}


def test_similar_light_sets_share_a_subset_they_enumerate():
    for n in range(1, 21):
        for m in range(n, 21):
            least = -(-85 * (n + m) // 185)  # overlap of a link
            if least <= n:
                assert any(k in subset_sizes(n, 85) and k in subset_sizes(m, 85) and k <= least
                           for k in [need(m, 85)])


def test_boundary_follows_the_counts():
    assert light_boundary({10: 100, 19: 100}, {10: 10**9, 19: 10**9}, 85) >= 19
    assert light_boundary({10: 100, 19: 10**6}, {10: 10**6, 19: 10}, 85) in range(10, 19)
    assert light_boundary({10: 100}, {}, 85) < 10


def test_components_of_chains_stars_and_loops(spark):
    rnd = np.random.default_rng(2)
    edges = [(k, k + 1) for k in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(7, 7), (300, 301), (301, 300)]
    rnd.shuffle(edges)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in edges], "a long, b long")
    got = {r.node: r.component for r in components(df, Scratch(spark, "t")).collect()}
    want = {k: 0 for k in range(61)} | {100 + k: 100 for k in range(40)} | {300: 300, 301: 300}
    assert got == want
    assert components(df.limit(0), Scratch(spark, "t")).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_prefixes_of_a_chain_across_the_light_boundary(documents, prose, percent):
    words = prose(8, 60).split()
    rows = [(k, " ".join(words[:k])) for k in range(4, 60)]
    assert found(jaccard_join(documents(rows), 4, percent)) == brute(rows, 4, percent)


def test_brute_force_helper_counts_sets():
    assert Counter(brute([(1, "a b c d e"), (2, "a b c d e")]).values()) == {(2, 1): 2}


@pytest.fixture
def stages(monkeypatch):
    """Rows of each table that the join writes, by name."""
    rows, write = {}, Scratch.stage

    def stage(self, df, name):
        out = write(self, df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "stage", stage)
    return rows


def test_lists_of_the_same_sets_are_one(documents, prose, stages):
    rows = [(10 * k + j, prose(300 + k, 400) + f" tail{j}") for k in range(3) for j in range(2)]
    assert found(jaccard_join(documents(rows))) == brute(rows)
    assert stages["scan-postings"] > 100  # a list for each of many shingles
    assert stages["entries"] == 6         # one for each two texts


def test_texts_below_the_threshold_make_no_pairs(documents, prose, stages):
    words = prose(400, 60).split()  # copies with one word changed each: 49 of 65 shingles in common
    rows = [(k, " ".join([*words[:5 * k + 4], f"x{k}", *words[5 * k + 5:]])) for k in range(11)]
    rows += [(100, rows[0][1]), (101, rows[0][1] + " more")]
    assert found(jaccard_join(documents(rows))) == brute(rows)
    assert sum(n for name, n in stages.items() if name.startswith("pairs")) <= 2


def test_parity_bitmaps_differ_in_at_most_the_shingles_that_differ():
    rnd = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rnd.integers(0, 1 << 62, rnd.integers(1, 900)).astype(np.uint64))
        b = np.union1d(a[rnd.random(len(a)) < 0.9], rnd.integers(0, 1 << 62, 40).astype(np.uint64))
        apart = sum(int(x).bit_count() for x in (J.parity(a) ^ J.parity(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))
