"""N-gram Jaccard join: a size-aware heavy-light join over word-shingle sets.

Light sets (few shingles) meet in fixed-size subsets: two sets of a similarity of t or
more share a subset of ceil(t * larger size) shingles, so each light set enumerates its
subsets of the sizes that a partner can ask for. Heavy sets scan inverted lists: under
one order of all shingles, two similar sets share a shingle among the first
n - ceil(t * n) + 1 of each. Where light ends is the size at which the subsets to write
would cost more than the list entries to scan, from counts over all sets.

Lists of the same sets are kept once, with their number. Sets that share a list are
compared by parity bitmaps first: each shingle flips a bit, so bitmaps that differ in more
bits than the two sets may differ in shingles rule the link out, and no row is made.

Links are never listed for whole groups. A list is first compared with a few leaders per
round, drawn from its largest component; what they link becomes one component, and only
pairs of different components remain to be compared. The last round compares all of
those, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.llm import bloom
from surveyspark.llm import words as W
from surveyspark.llm.components import components
from surveyspark.llm.scratch import Scratch

SMALL = 20          # sizes that may be light; larger sets have too many subsets
COMMON = 1 << 20    # most shingles whose place in the order is moved to the end
BLOCK = 1 << 22     # shingles of a task that are counted together
ROUNDS = 4          # most leader rounds before the exact last one
LEADERS = 4         # sets of a list that the others are compared with in a round
PARITY = 8          # 64-bit words of a set's parity bitmap


def need(n: int, percent: int) -> int:
    """Least overlap of a set of n shingles with any similar set: ceil(percent * n / 100)."""
    return -(-percent * n // 100)


def set_hash(items: np.ndarray) -> np.uint64:
    """Hash of a whole set; two different sets share it with a probability of about 2**-64."""
    size = np.array([len(items)], dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
    return W.mix(size + W.mix(items).sum(dtype=np.uint64))[0]


def parity(items: np.ndarray) -> np.ndarray:
    """Bitmap of a set: bit i tells whether an odd number of its shingles has i in its low bits."""
    odd = np.bincount((items & np.uint64(64 * PARITY - 1)).astype(np.int64), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The shingle set of each row's text, as sorted hashes."""
    hashes, at = W.words(batch.column("text"))
    for i in range(batch.num_rows):
        yield np.unique(W.shingles(hashes[at[i]:at[i + 1]], width))


def _common(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that most documents share, sorted by hash, and their counts.

    Counted per block of a task, where a shingle has to occur twice, over all documents. The counts only decide the order of shingles: any order gives the same
    links, this one keeps widespread passages out of the inverted lists. At most COMMON
    shingles come back.
    """
    def count(batches):
        held, size, seen = [], 0, set()
        for batch in W.slices(batches):
            for items in _sets(batch, width):
                if len(items) and (mark := int(set_hash(items))) not in seen:
                    seen.add(mark)
                    held.append(items)
                    size += len(items)
                if size >= BLOCK:
                    yield from flush(held)
                    size, seen = 0, set()
        yield from flush(held)

    def flush(held):
        if held:
            flat = np.concatenate(held)
            held.clear()
            flat.sort()
            same = flat[1:] == flat[:-1]
            first = np.flatnonzero(same & np.append(True, ~same[:-1]))  # runs of two or more
            if len(first):
                last = np.flatnonzero(same & np.append(~same[1:], True)) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.as_long(flat[first])), pa.array((last - first + 1).astype(np.int64))], ["h", "n"])

    counts = (docs.select("text").mapInArrow(count, "h long, n long")
              .groupBy("h").agg(F.sum("n").alias("n")).filter("n >= 6"))
    counts = counts.withColumn("level", F.floor(F.log2("n") * 4))
    counts = counts.persist()
    levels = counts.groupBy("level").count().collect()  # a row for each quarter power of two
    total, floor = 0, None
    for level, n in sorted(((r[0], r[1]) for r in levels), reverse=True):
        if total + n > COMMON:
            break
        total, floor = total + n, level
    if floor is None:
        counts.unpersist()
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    table = counts.filter(F.col("level") >= floor).select("h", "n").toArrow()
    counts.unpersist()
    h = table["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return h[order], table["n"].to_numpy()[order]


def _ordered_head(items: np.ndarray, common: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The first `size` shingles: rare ones by hash, then common ones by (count, hash)."""
    if not len(common):
        return items[:size]
    at = np.minimum(np.searchsorted(common, items), len(common) - 1)
    is_common = common[at] == items
    rare = items[~is_common]
    if len(rare) >= size:
        return rare[:size]
    rest, n = items[is_common], counts[at[is_common]]
    return np.concatenate([rare, rest[np.lexsort((rest, n))]])[:size]


def _set_table(docs: DataFrame, width: int, percent: int, common, counts) -> DataFrame:
    """doc_id, sig, n, the shingles that lists need (all of them up to SMALL), parity bitmap, hash of the text."""
    shared = docs.sparkSession.sparkContext.broadcast((common, counts))

    def rows(batches):
        common, counts = shared.value
        for batch in W.slices(batches):
            sigs, sizes, heads, bits = [], [], [], []
            for items in _sets(batch, width):
                n = len(items)
                sigs.append(set_hash(items) if n else 0)
                sizes.append(n)
                take = n if n <= SMALL else n - need(n, percent) + 1
                heads.append(_ordered_head(items, common, counts, take))
                bits.append(parity(items))
            bits = np.stack(bits)
            flat = np.concatenate(heads) if heads else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array(np.array(sigs, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(sizes, dtype=np.int64)),
                W.list_column(W.as_long(flat), np.array([len(x) for x in heads], dtype=np.int64)),
                *[pa.array(np.ascontiguousarray(bits[:, k])) for k in range(PARITY)],
                batch.column("mark"),
            ], ["doc_id", "sig", "n", "items", *_bits(), "mark"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("mark")).mapInArrow(
        rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, sig long, n long, items array<long>, "
              + ", ".join(f"{c} long" for c in (*_bits(), "mark")))


def _bits(side: str = "") -> list[str]:
    """Columns of the parity bitmap, of one side of a pair."""
    return [f"{side}bits{k}" for k in range(PARITY)]


def subset_sizes(n: int, percent: int) -> range:
    """Sizes of the subsets by which a set of n shingles can meet a partner."""
    return range(need(n, percent), n + 1)


def _subset_keys(sets: DataFrame, percent: int) -> DataFrame:
    """(key, sig, n): every subset of a light set of each size that a partner can ask for."""
    def rows(batches):
        for batch in batches:
            keys, sigs, sizes = [], [], []
            for sig, n, items in zip(*(batch.column(c).to_pylist() for c in ("sig", "n", "items"))):
                each = W.mix(np.array(items, dtype=np.int64).view(np.uint64))
                whole = each.sum(dtype=np.uint64)
                for size in subset_sizes(n, percent):
                    gone = [whole - each[list(c)].sum(dtype=np.uint64)
                            for c in combinations(range(n), n - size)]
                    keys.append(W.mix(np.array(gone, dtype=np.uint64) + np.uint64(size * 0x9E3779B1)))
                    sigs += [sig] * len(gone)
                    sizes += [n] * len(gone)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.as_long(np.concatenate(keys))), pa.array(sigs, pa.int64()),
                     pa.array(sizes, pa.int64())], ["key", "sig", "n"])

    return sets.select("sig", "n", "items").mapInArrow(rows, "key long, sig long, n long")


def _shared_lists(postings: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The postings (key, sig, n) of keys that two different sets have, with the list's length.

    Keys with the same sets are one list, under the least of them; `weight` is their number.
    Whether two lists hold the same sets is told by their lengths and two sums of hashes. Both sides of the join are written before: it then has a shuffle on each side, and a
    key of very many sets can be split.
    """
    distinct = scratch.stage(postings.dropDuplicates(["key", "sig"]), f"{name}-postings")
    lists = (distinct.groupBy("key")
             .agg(F.count("*").alias("length"), F.bit_xor(F.xxhash64("sig")).alias("one"),
                  F.bit_xor(F.xxhash64(F.lit(1), "sig")).alias("two")).filter("length > 1"))
    keys = scratch.stage(lists.groupBy("length", "one", "two")
                         .agg(F.min("key").alias("key"), F.count("*").alias("weight"))
                         .select("key", "length", "weight"), f"{name}-keys")
    return distinct.join(keys, "key")


def _repeated_postings(sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(key, sig, n, pos) for the prefix shingles that occur twice among all rows.

    The first shuffle moves shingles alone, added up within each task; a filter of those
    that occur twice keeps the second one to the few postings that can meet.
    """
    take = F.when(F.col("n") <= SMALL, F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1)
    prefix = F.slice("items", F.lit(1), F.coalesce(take, F.size("items").cast("long")).cast("int"))
    often = scratch.stage(sets.select(F.explode(prefix).alias("key")).groupBy("key").count()
                          .filter("count > 1").select("key"), "often")
    shared = sets.sparkSession.sparkContext.broadcast(bloom.build(often, "key"))

    def rows(batches):
        for batch in batches:
            lists = batch.column("keys")
            keys = lists.flatten().to_numpy().view(np.uint64)
            hit = np.flatnonzero(bloom.passes(*shared.value, keys))
            sizes = lists.value_lengths().to_numpy()
            row = pa.array(np.repeat(np.arange(batch.num_rows), sizes)[hit])
            place = (np.arange(len(keys)) - np.repeat(np.cumsum(sizes) - sizes, sizes))[hit] + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.as_long(keys[hit])), batch.column("sig").take(row), batch.column("n").take(row),
                 pa.array(place.astype(np.int64))], ["key", "sig", "n", "pos"])

    return sets.select(prefix.alias("keys"), "sig", "n").mapInArrow(rows, "key long, sig long, n long, pos long")


def light_boundary(sizes: dict[int, int], scans: dict[int, int], percent: int) -> int:
    """Largest light size: where subsets written plus list entries scanned are fewest."""
    def subsets(n):
        return sizes.get(n, 0) * sum(comb(n, k) for k in subset_sizes(n, percent))

    tried = range(SMALL + 1)
    return min(tried, key=lambda x: sum(map(subsets, range(1, x + 1)))
               + sum(scans.get(n, 0) for n in range(x + 1, SMALL + 1)))


def _similar(a: str, b: str, percent: int) -> F.Column:
    return F.least(F.col(a), F.col(b)) * 100 >= F.greatest(F.col(a), F.col(b)) * percent


def _in_place(percent: int) -> F.Column:
    """Whether a shared shingle's places in both orders leave room for the overlap of a link.

    At most as many shingles are shared up to it as the nearer place counts, and after it
    as the shorter rest holds; true for every shared shingle of a link.
    """
    wanted = F.ceil((F.col("an") + F.col("bn")) * percent / F.lit(100 + percent))
    return F.least("apos", "bpos") + F.least(F.col("an") - F.col("apos"), F.col("bn") - F.col("bpos")) >= wanted


def _near_bits(percent: int) -> F.Column:
    """Whether the parity bitmaps differ in no more bits than linked sets may differ in shingles."""
    apart = sum(F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(_bits("a"), _bits("b")))
    return apart * (100 + percent) <= (F.col("an") + F.col("bn")) * (100 - percent)


def _promising(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, an, bn, one row for each shared list) whose shared keys allow a link.

    A shared shingle outside both list prefixes comes from the rest of one set, so the
    overlap is at most the shared list keys plus the larger rest. Subset keys always count.
    """
    def rest(n):
        return F.ceil(F.col(n) * percent / F.lit(100)) - 1

    wanted = F.ceil((F.col("an") + F.col("bn")) * percent / F.lit(100 + percent))
    return (pairs.groupBy("a", "b", "an", "bn")
            .agg(F.sum("weight").alias("lists"), F.min("scan").alias("only_lists"))
            .filter(~F.col("only_lists") | (F.col("lists") + F.greatest(rest("an"), rest("bn")) >= wanted))
            .select("a", "b"))


def _whole_sets(docs: DataFrame, marks: DataFrame, width: int) -> DataFrame:
    """(sig, items) of the sets of the texts with these hashes, from a second reading of the texts.

    Texts that share a bit of the filter by chance come along; the join by sig drops them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(marks, "mark"))

    def rows(batches):
        seen: set[int] = set()
        for batch in W.slices(batches):
            marks = batch.column("mark").to_numpy()
            hit = [i for i in np.flatnonzero(bloom.passes(*shared.value, marks.view(np.uint64)))
                   if int(marks[i]) not in seen]
            sets = [items for items in _sets(batch.take(pa.array(hit, pa.int64())), width) if len(items)] if hit else []
            if sets:
                if len(seen) < 1 << 20:  # copies in one task come once; others are dropped later
                    seen.update(int(marks[i]) for i in hit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.as_long(np.array([set_hash(items) for items in sets], dtype=np.uint64))),
                     W.list_column(W.as_long(np.concatenate(sets)), np.array([len(x) for x in sets]))],
                    ["sig", "items"])

    return docs.select("text", F.xxhash64("text").alias("mark")).mapInArrow(rows, "sig long, items array<long>")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have the similarity asked for, by their whole sets."""
    left = pairs.join(sets.select(F.col("sig").alias("a"), F.col("items").alias("x")), "a")
    both = left.join(sets.select(F.col("sig").alias("b"), F.col("items").alias("y")), "b")
    inter = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - inter
    return both.filter(inter * 100 >= union * percent).select("a", "b").distinct()


def similar_sets(docs: DataFrame, width: int = 4, percent: int = 85,
                 scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """Shingle sets of all documents and the components of their links.

    `docs` needs doc_id and text; other columns are ignored. Returns (sets, groups):
    sets has a row per row of docs with doc_id, sig (the set; 0 and n = 0 when there is
    no word) and n; groups has (node, component) for the sets with a link to a different
    set. A null text has no words; copies share a set and need no link.
    """
    spark: SparkSession = docs.sparkSession
    scratch = scratch or Scratch(spark, "jaccard")
    common, counts = _common(docs, width)
    sets = scratch.stage(_set_table(docs, width, percent, common, counts), "sets")
    filled = sets.filter("n > 0")
    lists = scratch.stage(_shared_lists(_repeated_postings(filled, percent, scratch), scratch, "scan"), "lists")

    small = filled.filter(F.col("n") <= SMALL).dropDuplicates(["sig"])
    sizes = {r[0]: r[1] for r in small.groupBy("n").count().collect()}
    scans = {r[0]: r[1] for r in lists.filter(F.col("n") <= SMALL).groupBy("n").agg(F.sum("length")).collect()}
    # a scanned set writes its list entries, too
    scans = {n: scans.get(n, 0) + m * (n - need(n, percent) + 1) for n, m in sizes.items()}
    light = light_boundary(sizes, scans, percent)
    subsets = _shared_lists(_subset_keys(small.filter(F.col("n").between(1, light)), percent), scratch, "subset")
    scanned = lists.filter(F.col("n") >= need(light + 1, percent)).withColumn("scan", F.lit(True))
    subsets = subsets.withColumns({"pos": F.lit(0).cast("long"), "scan": F.lit(False)})
    names = ["key", "sig", "n", "pos", "scan", "weight"]
    entries = scratch.stage(
        scanned.select(*names).union(subsets.select(*names))
        .join(filled.select("sig", *_bits()).dropDuplicates(["sig"]), "sig"), "entries")
    scratch.drop("lists", "often", "scan-postings", "scan-keys", "subset-postings", "subset-keys")

    groups, rows, before = None, entries.count(), None
    for turn in range(ROUNDS + 1):
        if groups is None:
            now = entries.withColumn("part", F.col("sig"))
        else:
            now = (entries.join(groups.withColumnRenamed("node", "sig"), "sig", "left")
                   .withColumn("part", F.coalesce("component", "sig")).drop("component"))
        parts = now.groupBy("key", "scan", "part").agg(F.count("*").alias("m"))
        open_keys = (parts.groupBy("key", "scan")
                     .agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"),
                          F.count("*").alias("parts")).filter("parts > 1"))
        # pairs of different components, and those of them that a leader round would spare
        pairs_left = (F.col("m") * F.col("m") - F.col("own")) / 2
        left, spared = open_keys.agg(
            F.sum(pairs_left), F.sum(F.greatest(F.lit(0), pairs_left - LEADERS * F.col("m")))).first()
        if not left:
            break
        now = now.join(open_keys.select("key", "scan"), ["key", "scan"], "left_semi")
        # leaders are tried while they settle much; texts that merely share a passage they do not
        last = spared <= rows / 4 or turn == ROUNDS or (before is not None and spared > 0.7 * before)
        before = spared
        one = now.select("key", "scan", F.col("sig").alias("a"), F.col("n").alias("an"), F.col("part").alias("ap"),
                         F.col("pos").alias("apos"), *[F.col(c).alias(f"a{c}") for c in _bits()])
        if not last:
            sized = one.join(parts.select("key", "scan", F.col("part").alias("ap"), "m"), ["key", "scan", "ap"])
            drawn = [F.min_by(F.struct("a", "an", "ap", "apos", *_bits("a")),
                              F.struct(-F.col("m"), F.xxhash64("a", F.lit(turn * LEADERS + j))))
                     for j in range(LEADERS)]
            one = (sized.groupBy("key", "scan").agg(F.array_distinct(F.array(*drawn)).alias("leaders"))
                   .select("key", "scan", F.explode("leaders").alias("leader")).select("key", "scan", "leader.*"))
        other = now.select("key", "scan", F.col("sig").alias("b"), F.col("n").alias("bn"), F.col("part").alias("bp"),
                           F.col("pos").alias("bpos"), "weight", *[F.col(c).alias(f"b{c}") for c in _bits()])
        pairs = one.join(other, ["key", "scan"]).filter(
            (F.col("a") < F.col("b") if last else F.lit(True)) & (F.col("ap") != F.col("bp"))
            & _similar("an", "bn", percent)
            & (~F.col("scan") | ((F.greatest("an", "bn") > light) & _in_place(percent)))
            & _near_bits(percent)).drop(*_bits("a"), *_bits("b"))
        if not last:  # two leaders of a list are one pair
            pairs = pairs.withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b"),
                                       "an": F.when(F.col("a") < F.col("b"), F.col("an")).otherwise(F.col("bn")),
                                       "bn": F.when(F.col("a") < F.col("b"), F.col("bn")).otherwise(F.col("an"))})
            pairs = pairs.dropDuplicates(["key", "scan", "a", "b"])
        pairs = scratch.stage(_promising(pairs, percent), f"pairs{turn}")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
        marks = filled.join(wanted, "sig").groupBy("sig").agg(F.min("mark").alias("mark"))  # one text of each set
        whole = scratch.stage(_whole_sets(docs, marks, width), f"whole{turn}")
        found = _links(pairs, whole, percent)
        if groups is not None:  # links between components known so far join those
            found = found.union(groups.select("node", "component"))
        groups = scratch.stage(components(found, scratch, f"round{turn}"), f"groups{turn}")
        scratch.drop(f"pairs{turn}", f"whole{turn}")
        if last:
            break
    if groups is None:
        groups = spark.createDataFrame([], "node long, component long")
    scratch.drop("entries")
    return sets.select("doc_id", "sig", "n"), groups


def jaccard_join(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every document.

    component_id is the least doc_id reachable by links (a similarity of percent / 100 or
    more between shingle sets; copies are links). A document without words is alone. Rows
    with a null doc_id are kept, count as nodes, but give no component its name; a
    component of only such rows has a null component_id. Repeated rows come back repeated.
    """
    sets, groups = similar_sets(docs, width, percent)
    named = (sets.join(groups.withColumnRenamed("node", "sig"), "sig", "left")
             .withColumn("part", F.coalesce("component", "sig")).drop("component"))
    heads = named.filter("n > 0").groupBy("part").agg(F.min("doc_id").alias("head"))
    return (named.join(heads, "part", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("head")).otherwise(F.col("doc_id")).alias("component_id")))


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """`docs` without near copies: the least doc_id of each component stays, whole.

    Documents without words and rows with a null doc_id all stay. Rows that share a doc_id
    are one document: they stay together, or go when one of them is not the least.
    """
    joined = jaccard_join(docs.select("doc_id", "text"), width, percent)
    gone = joined.filter("n_shingles > 0 and doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
