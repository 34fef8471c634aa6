import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from surveyspark.llm import fingerprint as fp


def shingles(text, width=5):
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text.lower()) if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture
def corpus(prose):
    rnd = random.Random(5)
    rows = [(rnd.randrange(-10**12, 10**15), prose(k, rnd.randrange(0, 400))) for k in range(150)]
    rows += [(k, prose(1000 + k, 60)) for k in range(300)]  # a dense range of ids beside the sparse one
    rows += [(-5, None), (-4, ""), (-3, "é"), (-2, "  one two "), (-1, "ONE two")]
    rnd.shuffle(rows)
    return rows


def test_edited_texts_and_likenesses(documents, corpus):
    got = {r.doc_id: r for r in fp.fingerprint_documents(documents(corpus)).collect()}
    rows = sorted((i, t or "") for i, t in corpus)
    errors = []
    for k, (i, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        errors += [abs(r.near_edited - jaccard(shingles(text), shingles(edited))),
                   abs(r.near_next - jaccard(shingles(text), shingles(after)))]
        assert r.fingerprint != r.edited_fingerprint or edited.split() == text.split()
    assert max(errors) < 0.2 and sum(errors) / len(errors) < 0.03
    assert got[-2].fingerprint == got[-1].fingerprint and got[-5].fingerprint == ""


def test_ties_null_ids_and_small_tables(documents):
    rows = [(None, "a b"), (None, "c d"), (7, "x y"), (7, "x y"), (3, "lone")]
    got = fp.fingerprint_documents(documents(rows))
    assert sorted(str(r.doc_id) for r in got.collect()) == ["3", "7", "7", "None", "None"]
    one = fp.fingerprint_documents(documents([(1, "abcd")])).collect()[0]
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert fp.fingerprint_documents(documents([])).count() == 0


def test_no_python_and_one_shuffle_of_texts(documents, corpus):
    df = fp.fingerprint_documents(documents(corpus))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_merge_and_estimates(spark, prose):
    left, right = prose(1, 3000), prose(2, 1500)
    both = left + " " + right
    df = spark.createDataFrame([(left, right, both)], "a string, b string, c string")
    sk = {c: fp.sketch(fp.word_hashes(F.col(c))) for c in "abc"}
    row = df.select(*[v.alias(k) for k, v in sk.items()]).select(
        "a", "c", fp.merge(F.col("a"), F.col("b")).alias("m"), fp.distinct_shingles(F.col("c")).alias("n"),
        fp.containment(F.col("a"), F.col("c")).alias("inside"), fp.resemblance(F.col("a"), F.col("c")).alias("j")).first()
    assert len(set(row.m) ^ set(row.c)) <= 16  # but for the shingles across the seam
    true = len(shingles(both))
    assert abs(row.n / true - 1) < 0.3 and row.inside > 0.75
    assert abs(row.j - jaccard(shingles(left), shingles(both))) < 0.15


def test_parts_merge_to_the_whole(spark):
    parts = spark.createDataFrame([("x", [5, 9, 11]), ("x", [1, 9]), ("x", None), ("y", []), (None, [4])],
                                  "k string, v array<long>")
    got = {r.k: r.v for r in fp.merge_parts(parts, "k", "v", k=3).collect()}
    assert got == {"x": [1, 5, 9], "y": [], None: [4]}
