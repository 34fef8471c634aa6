import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from surveyspark.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = (row[0], row[3], row[2], row[4], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """Root, and the siblings left and right of every node on its way up."""
    paths, level = [[] for _ in nodes], [([i], d) for i, d in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for k in range(0, len(level), 8):
            run = level[k:k + 8]
            for at, (members, _) in enumerate(run):
                for m in members:
                    paths[m].append(([d for _, d in run[:at]], [d for _, d in run[at + 1:]]))
            above.append((sum((m for m, _ in run), []), sha("".join(d for _, d in run))))
        level = above
    return level[0][1], paths


def brute(rows):
    if not rows:
        return []
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {v: tree([x[2] for x in sorted(by_lang[v], key=lambda x: x[:3])]) for v in langs}
    root, tops = tree([trees[v][0] for v in langs])
    out = []
    for v, top in zip(langs, tops):
        sub, paths = trees[v]
        for (_, _, own, r), path in zip(sorted(by_lang[v], key=lambda x: x[:3]), paths):
            path = path + top
            now = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                now = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]))
            proof = sha("".join("".join(a + b) for a, b in path))
            for a, b in path:
                now = sha("".join(a) + now + "".join(b))
            out.append((r[0], own, sub, root, proof, now, now == root))
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", 1) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, node string, rank int").repartition(5)


def got(spark, rows):
    df = merkle.verified_manifest(frame(spark, rows))
    return [tuple(r) for r in df.collect()]


def key(r):
    return tuple(str(x) for x in r)


@pytest.mark.parametrize("sizes", [(), (1,), (8,), (9, 1), (64, 65, 2), (200, 7, 1, 1, 1, 1, 1, 1, 1, 3)])
def test_equals_a_plain_tree(spark, sizes):
    rnd = random.Random(len(sizes))
    langs = [None, "", "é", "z", "a", "ab", "日本", "c", "d", "e"]
    rows = []
    for lang, n in zip(langs, sizes):
        for _ in range(n):
            rows.append((rnd.randrange(-10**9, 10**15), rnd.choice(["Äbc DEF", "plain", None, "", "É A"]), lang,
                         rnd.choice([None, "s", "š:1"]), rnd.choice([None, 5])))
    assert sorted(got(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_nulls_repeated_rows_and_one_id_for_a_third(spark):
    rows = [(None, "A", "x", None, 1), (None, None, None, None, None)] * 3
    rows += [(7, f"Text {k}", "x", "s", 6) for k in range(40)]
    rows += [(8, "Same", "x", "s", 4)] * 40
    rows += [(k, "Word " * 3000, "x", "s", 15000) for k in range(100, 140)]
    assert sorted(got(spark, rows), key=key) == sorted(brute(rows), key=key)


def test_general_outputs(spark):
    rows = [(k, f"T {k}", "x", "s", 3) for k in range(70)]
    df = merkle.manifest(frame(spark, rows))
    r = df.filter(F.col("doc_id") == 9).first()
    assert [(len(s.left) // 32, len(s.right) // 32) for s in r.path] == [(1, 6), (1, 6), (0, 1)]
    assert (r.changed is None) == (zlib.crc32(b"9") % 3 != 0)
    assert df.select(F.countDistinct("root")).first()[0] == 1
