"""Sentence-span dedup, decontamination and language identification."""

import re

import numpy as np
import pyarrow as pa
import pytest

from surveyspark.llm import words as W
from surveyspark.llm.decontaminate import Benchmark, common_subsequence, contaminated, passage_sums, starts, without_leaks
from surveyspark.llm.language import FAMILIES, Model, family_of, features, fit, identify_language, known_languages
from surveyspark.llm.sentence_dedup import dedup_sentences


def sentences(text):
    raw = (text or "").encode()
    words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(rb"[^\x20\x09-\x0d]+", raw)]
    out, now = [], []
    for k, (a, b, _) in enumerate(words):
        now.append(k)
        after = words[k + 1][0] if k + 1 < len(words) else len(raw)
        w = raw[a:b]
        closed = len(w) > 1 and w[-1:] in (b'"', b"'", b")", b"]") and w[-2:-1] in (b".", b"!", b"?")
        if w[-1:] in (b".", b"!", b"?") or closed or b"\n" in raw[b:after] or k + 1 == len(words):
            out.append(now)
            now = []
    return raw, words, out


def brute_dedup(rows, least=25):
    parsed, places = {i: sentences(t) for i, t in rows}, {}
    for i in sorted(parsed):
        _, words, found = parsed[i]
        runs = set()
        for j in range(len(found)):
            for step in (1, -1):
                n, k = 0, j
                while 0 <= k < len(found):
                    n += len(found[k])
                    if n >= least:
                        runs.add((min(j, k), max(j, k)))
                        break
                    k += step
        for j, k in sorted(runs):
            places.setdefault(tuple(words[x][2] for s in found[j:k + 1] for x in s), []).append((i, j, k))
    gone = {}
    for p in places.values():
        p.sort()
        for i, j, k in p:
            if (i, j) != p[0][:2]:
                gone.setdefault(i, set()).update(range(j, k + 1))
    out = {}
    for i, t in rows:
        raw, words, found = parsed[i]
        cut, begin = gone.get(i, set()), [words[s[0]][0] for s in found] + [len(raw)]
        left = b"".join(raw[begin[j]:begin[j + 1]] for j in range(len(found)) if j not in cut)
        out[i] = ((raw[:begin[0]] + left).decode().rstrip(), len(cut)) if cut else (t, 0)
    return out


def test_dedup_equals_brute_force(documents, prose):
    passage = prose(1, 60)
    rows = [(0, None), (1, ""), (2, " .\n"), (3, passage), (4, prose(2, 80) + " " + passage + " " + prose(3, 80)),
            (5, prose(4, 30) + "\n" + passage.upper() + "\nEnd."), (6, passage + " " + passage), (7, prose(5, 400)),
            (8, 'He said "no." ' + prose(6, 40)), (9, "short. line."), (10, "short. line."), (11, passage)]
    got = dedup_sentences(documents(rows))
    assert got.columns == [*documents([]).columns, "n_removed"]
    rows_got = {r.doc_id: r for r in got.collect()}
    want = brute_dedup(rows)
    assert {i: (r.text, r.n_removed) for i, r in rows_got.items()} == want
    assert want[11] == ("", want[11][1]) and want[9][1] == 0 and want[7][1] == 0
    assert rows_got[4].n_chars == len(want[4][0]) and rows_got[7].n_chars == 7


def test_dedup_of_repeated_rows_null_ids_and_nothing(documents, prose):
    text = prose(1, 50)
    rows = sorted(dedup_sentences(documents([(None, text), (3, text), (3, text)])).collect(), key=lambda r: str(r.doc_id))
    assert [(r.doc_id, r.text) for r in rows] == [(3, ""), (3, ""), (None, text)]
    twice = dedup_sentences(documents([(3, text), (3, text)])).collect()
    assert [r.text for r in twice] == [text, text]
    assert dedup_sentences(documents([])).count() == 0


def test_longest_common_subsequence_and_passages():
    rnd = np.random.default_rng(1)
    for _ in range(50):
        a, b = rnd.integers(1, 5, rnd.integers(1, 12)), rnd.integers(1, 5, rnd.integers(0, 15))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert common_subsequence(a, b) == table[-1, -1]
    vectors = rnd.standard_normal((9, 3)).astype(np.float32)
    vectors[0] = 0
    texts = [rnd.integers(0, 9, n) for n in (0, 1, 15, 16, 17, 32, 33, 70)]
    sums, text, place = passage_sums(vectors, texts)
    at = 0
    for k, t in enumerate(texts):
        for p, s in enumerate(starts(len(t))):
            assert (text[at], place[at]) == (k, p)
            assert np.allclose(sums[at], vectors[t[s:s + 32]].sum(axis=0), atol=1e-4)
            at += 1
    assert at == len(sums)


@pytest.fixture
def leak_case(spark, documents, prose):
    items = [(k, prose(900 + k, 20 + 3 * k)) for k in range(12)] + [(50, None), (51, ""), (None, "a b c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, prose(k, 300)) for k in range(60)] + [(100, None), (101, ""), (102, "tiny")]
    for k in range(12):
        words = items[k][1].split()
        rows.append((200 + k, prose(300 + k, 45 + 7 * k) + " " + " ".join(words).upper() + " " + prose(400 + k, 90)))
        changed = ["zz" if j % 10 == 4 else w for j, w in enumerate(words)]
        rows.append((300 + k, prose(500 + k, 33) + " " + " ".join(changed) + " " + prose(600 + k, 50)))
    return documents(rows), bench, rows, items


def test_every_verbatim_and_changed_item_is_found_and_nothing_else(leak_case):
    docs, bench, rows, items = leak_case
    got = {(r.doc_id, r.item_id): r for r in contaminated(docs, bench).collect()}
    assert set(got) == {(200 + k, k) for k in range(12)} | {(300 + k, k) for k in range(12)}
    assert all(got[200 + k, k].lcs_share == 1 for k in range(12))
    kept = without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i < 200}


@pytest.mark.parametrize("step", [7, 10])
def test_changed_copies_in_a_third_of_the_documents_are_found(spark, documents, prose, step):
    """Words that are frequent only because of the copies still show them."""
    bench = spark.createDataFrame([(k, prose(900 + k, 20 + 3 * k)) for k in range(12)], "item_id long, text string")
    for k in (3, 8):
        words = prose(900 + k, 20 + 3 * k).split()
        changed = " ".join("zz" if j % step == 4 else w for j, w in enumerate(words))
        rows = [(i, prose(i, 120)) for i in range(60)]
        rows += [(100 + i, f"{prose(200 + i, 30 + i)} {changed} {prose(300 + i, 60)}") for i in range(30)]
        got = {(r.doc_id, r.item_id) for r in contaminated(documents(rows), bench).collect()}
        assert got == {(100 + i, k) for i in range(30)}


def test_candidate_search_recall_against_brute_force(leak_case):
    """Every pair whose words have a long common subsequence anywhere is among the leaks."""
    docs, bench, rows, items = leak_case
    named = [(i, t) for i, t in items if i is not None and t]
    b = Benchmark([i for i, _ in named], [t.lower() for _, t in named])
    want = set()
    for doc, text in rows:
        h, at = W.words(pa.array([(text or "").lower()], pa.large_string()), bare=True)
        ids = b.code(h)
        for (i, _), item in zip(named, b.items):
            spans = (ids[k:k + int(1.3 * len(item))] for k in range(0, max(1, len(ids) - len(item) // 2), 4))
            if any(common_subsequence(item, s[s > 0]) >= 0.8 * len(item) for s in spans):
                want.add((doc, i))
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert len(want & got) >= 0.9 * len(want) and len(want) >= 20


def test_leaks_of_empty_tables(spark, documents):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert contaminated(documents([]), bench).count() == 0
    assert contaminated(documents([(1, "one two three")]), bench.limit(0)).count() == 0
    assert without_leaks(documents([(1, "x"), (None, None)]), bench.limit(0)).count() == 2


VOCABULARY = {
    "en": "the of and to in is that with for was are this not have from".split(),
    "de": "der die und das nicht ist mit für auf ein werden ich sie zu den".split(),
    "fr": "le la les et des une dans est pour que qui sur pas plus avec".split(),
    "es": "el los las y del una en es por que con para como más pero".split(),
}


@pytest.fixture
def spoken(spark):
    rnd = np.random.default_rng(4)
    rows = []
    for k in range(400):
        lang = list(VOCABULARY)[k % 4]
        rows.append((k, " ".join(rnd.choice(VOCABULARY[lang], rnd.integers(3, 60))), lang, "a"))
    rows += [(1000, None, "en", "a"), (1001, "123 !!", "fr", "b"), (1002, "", None, "c"), (1003, "der die und", None, "d"),
             (None, "les une dans est pour", "fr", "e"), (5, "el los las una", "es", "f")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_language_of_held_out_texts(spoken):
    got = identify_language(spoken).join(spoken.withColumnRenamed("score", "s"), "doc_id").collect()
    held = [r for r in got if r.held_out and r.lang and r.doc_id < 1000]
    assert len(held) > 60 and sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    assert identify_language(spoken).count() == spoken.count()


def test_labels_of_held_out_documents_do_not_matter(spark, spoken):
    from pyspark.sql import functions as F

    from surveyspark.llm.language import held_out

    other = spoken.withColumn("lang", F.when(held_out(), F.lit("zz")).otherwise(F.col("lang")))
    a = {r.doc_id: (r.lang_pred, r.score) for r in identify_language(spoken).collect()}
    assert a == {r.doc_id: (r.lang_pred, r.score) for r in identify_language(other).collect()}


def test_rejected_texts_go_and_columns_stay(spoken):
    kept = known_languages(spoken)
    assert kept.columns == spoken.columns
    rows = kept.collect()
    assert len(rows) == spoken.count() - 3 and {r.score for r in rows} >= {"a", "e", "f"}
    assert next(r for r in rows if r.doc_id == 1003).lang == "de"


def test_language_without_labels_or_rows(spark, documents, spoken):
    assert {r.lang_pred for r in identify_language(spoken.withColumn("lang", spoken.lang.substr(9, 1)).filter("1=0")).collect()} == set()
    unlabelled = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert identify_language(unlabelled).collect()[0][2:] == ("und", 0.0)


def test_hierarchy_of_machines():
    assert family_of("de-AT") == "germanic" and family_of("tlh") == "tlh"
    codes = [c for v in FAMILIES.values() for c in v]
    assert len(codes) == len(set(codes))
    texts = [" ".join(VOCABULARY[v][k % 7:k % 7 + 6]) for v in VOCABULARY for k in range(30)]
    langs = [v for v in VOCABULARY for _ in range(30)]
    x = features(pa.array(texts))
    model = Model(x, langs)
    assert model.families == ["germanic", "romance"]
    assert [p[1:] for p in model.pairs] == [("de", "en"), ("es", "fr")]
    assert sum(a == b for a, b in zip(model.predict(x)[0], langs)) >= 115
    alone = Model(x[:30], ["en"] * 30)
    assert alone.predict(x[:2])[0] == ["en", "en"]


def test_no_language_is_too_large_or_too_rare_to_be_learned(spark):
    docs = spark.range(1_500_000).selectExpr("id doc_id", "if(id % 150000 = 7, 'wo ist der hund', 'where is it') text",
                                             "if(id % 150000 = 7, 'de', 'en') lang")
    model = fit(docs, 2)
    assert model.langs == ["de", "en"]


@pytest.mark.parametrize("gram_words", [4096, 0])
def test_latent_axes_are_those_of_all_passages(spark, tmp_path, gram_words):
    """More passages than any sample: the axes equal those of all passages, computed at once."""
    from surveyspark.llm.decontaminate import Settings, _coded, _document_counts, _weights, latent_axes
    from surveyspark.llm.scratch import Scratch

    rnd = np.random.default_rng(5)
    vocabulary = [f"w{k}" for k in range(12)]
    texts = [" ".join(rnd.choice(vocabulary, 3)) for _ in range(64_000)] + [" ".join(vocabulary * 4), "other", ""]
    b = Benchmark([1, 2], ["w0 w1 w2 w3 w4 w5 w6", "w7 w8 w9 w10 w11 w0"])
    bench = spark.sparkContext.broadcast(b)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = _coded(docs, bench)
    df, n, passages = _document_counts(coded, bench)
    assert n == len(texts) and passages > 64_000
    weight = _weights(df, n)
    axes = latent_axes(coded, bench, weight, passages, Settings(rank=3, gram_words=gram_words), Scratch(spark, "axes"))

    def rows(ids):
        for s in starts(len(ids)):
            count = np.bincount(ids[s:s + 32], minlength=13).astype(float)
            v = np.where(count > 0, 1 + np.log(np.maximum(count, 1)), 0) * weight
            if v.any():
                yield v / np.linalg.norm(v)

    coded_texts = [np.array([vocabulary.index(w) for w in t.split() if w in vocabulary], int) for t in texts]
    at = b.code(W.words(pa.array([" ".join(vocabulary)], pa.large_string()), bare=True)[0])
    theirs = np.array([v for t in coded_texts for v in rows(at[t])])
    ours = np.array([v for item in b.items for v in rows(item)])
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((13, 3)))[0]
    for _ in range(3):
        basis = np.linalg.qr(ours.T @ (ours @ basis) / len(ours) + theirs.T @ (theirs @ basis) / len(theirs))[0]
    assert np.abs(axes @ axes.T - basis @ basis.T).max() < 1e-4


def test_pair_sums_are_kept_without_the_mirrored_half():
    from surveyspark.llm.decontaminate import _add_pairs, _tfidf, line_starts

    rnd = np.random.default_rng(2)
    rows = _tfidf(np.append(0, rnd.random(40)).astype(np.float32), [rnd.integers(0, 41, 300) for _ in range(5)])
    begin = line_starts(41)
    total = np.zeros(begin[-1])
    a = np.zeros((rows[0].max() + 1, 41))
    a[rows[0], rows[1]] = rows[2]
    assert len(total) == 41 * 42 // 2 and _add_pairs(total, begin, rows) == len(a)
    assert np.allclose(total, (a.T @ a)[np.triu_indices(41)])
