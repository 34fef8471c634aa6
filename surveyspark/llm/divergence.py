"""How the sources of a language differ in the words they use, in exact integers.

Terms are counted by sorting pointers. A shard of texts, ordered by language and
source, is one byte buffer; a pointer marks the start of every term in it. The pointers
are sorted by the terms they point at: by the next eight bytes, then every run that is
still equal by the eight after them, until the terms end (multikey quicksort over
slices). An equal run is one term; since the sort is stable, its pointers stand by
language, source and document, so occurrences and documents are run lengths. Shards'
counts are added up in their task, then by a grouped sum.

The sum over all kept terms of the divergence between two sources is taken apart, so
that terms which neither or only one of them uses need no row for the pair:

    sum over t of F(p, q) = V F(p0, q0) + sum over t in A of (F(p, q0) - F(p0, q0))
                          + sum over t in B of (F(p0, q) - F(p0, q0))
                          + sum over t in both of (F(p, q) - F(p, q0) - F(p0, q) + F(p0, q0))

with p0, q0 the shares of a term that does not occur. The second and third sums follow
from how often each share occurs in a source; the last is taken over the terms, each
with the sources that use it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.llm import words as W
from surveyspark.llm.scratch import Scratch

SHARD = 1 << 23       # bytes of text sorted together
HELD = 1 << 20        # rows of counts a task holds before it adds them up
PAIRS = 1 << 18       # pairs of sources compared at once
UNIT = 1_000_000_000  # fixed value: what a share is expressed in
LEAST_DOCS = 3        # fixed value: documents of its language that hold a kept term
TOP_TERMS = 200       # fixed value: terms reported of a group

LETTER = np.ones(256, dtype=bool)
LETTER[:0x80] = False
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True
_MASK = np.array([0] + [((1 << 8 * k) - 1) << 8 * (8 - k) for k in range(1, 9)], dtype=np.uint64)

COUNTS = "lang string, source string, term string, n long, docs long"
_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])


def pointers(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every term of texts laid end to end."""
    inside = LETTER[raw]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = rows[(rows > 0) & (rows < len(raw))]
    start[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def sort_pointers(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of the pointers by term, and which of them begin an equal run.

    `raw` has eight bytes after the last term. Only runs of several pointers whose terms
    go on are sorted by a further slice.
    """
    window = np.lib.stride_tricks.sliding_window_view(raw, 8)

    def slices(which: np.ndarray, depth: int) -> np.ndarray:
        at = start[which] + depth
        left = np.clip(end[which] - at, 0, 8)
        return window[np.minimum(at, len(window) - 1)].view(">u8").ravel().astype(np.uint64) & _MASK[left]

    everything = np.arange(len(start))
    key = slices(everything, 0)
    order = np.argsort(key, kind="stable")
    first = np.ones(len(order), dtype=bool)
    first[1:] = key[order[1:]] != key[order[:-1]]
    depth = 8
    while True:
        run = np.cumsum(first) - 1
        several = np.bincount(run, minlength=1) > 1
        at = np.flatnonzero(several[run])
        if len(at):  # of an equal run all terms go on or end at this depth
            longest = np.maximum.reduceat(end[order[at]] - start[order[at]],
                                          np.flatnonzero(np.append(True, run[at][1:] != run[at][:-1])))
            at = at[np.repeat(longest > depth, np.unique(run[at], return_counts=True)[1])]
        if not len(at):
            return order, first
        key = slices(order[at], depth)
        again = np.lexsort((key, run[at]))
        order[at] = order[at][again]
        key, same = key[again], run[at]
        new = np.append(True, (key[1:] != key[:-1]) | (same[1:] != same[:-1]))
        first[at] = first[at] | new
        depth += 8


def shard_counts(shard: pa.Table) -> pa.Table:
    """lang, source, term, n, docs of the texts of a shard (lang, source, text without nulls)."""
    shard = shard.sort_by([("lang", "ascending"), ("source", "ascending")])
    raw, rows = W.buffers(W.strings(shard["text"]))
    raw = np.append(W.LOWER[raw], np.zeros(8, np.uint8))
    start, end = pointers(raw[:-8], rows)
    if not len(start):
        return _SCHEMA.empty_table()
    order, first = sort_pointers(raw, start, end)
    row = (np.searchsorted(rows, start, side="right") - 1)[order]
    lang, source = (shard[c].combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "source"))
    group = lang[row].astype(np.int64) << 32 | source[row]
    new_group = first.copy()
    new_group[1:] |= group[1:] != group[:-1]
    new_doc = new_group.copy()
    new_doc[1:] |= row[1:] != row[:-1]
    begin = np.flatnonzero(new_group)
    a, b = start[order[begin]], end[order[begin]]
    offsets = np.append(0, np.cumsum(b - a))
    taken = np.repeat(a - offsets[:-1], b - a) + np.arange(offsets[-1])
    terms = pa.LargeStringArray.from_buffers(
        len(a), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(raw[taken].tobytes()))
    held = pa.array(row[begin])
    return pa.table({
        "lang": shard["lang"].take(held), "source": shard["source"].take(held), "term": terms.cast(pa.string()),
        "n": np.diff(np.append(begin, len(order))), "docs": np.add.reduceat(new_doc.astype(np.int64), begin),
    }, schema=_SCHEMA)


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a task's texts, shard by shard."""
    shard, size, held, rows = [], 0, [], 0

    def added() -> pa.Table:
        total = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return total.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(_SCHEMA.names)

    for batch in W.slices(batches):
        text = W.strings(batch.column("text"))
        shard.append(pa.table({"lang": batch.column("lang"), "source": batch.column("source"), "text": text}))
        size += pc.sum(pc.binary_length(text)).as_py() or 0
        if size >= SHARD:
            held.append(shard_counts(pa.concat_tables(shard)))
            shard, size, rows = [], 0, rows + held[-1].num_rows
        if rows > HELD:
            held = [added()]
            rows = held[0].num_rows
            if rows > HELD // 2:
                yield from held[0].to_batches(1 << 15)
                held, rows = [], 0
    if shard:
        held.append(shard_counts(pa.concat_tables(shard)))
    if held:
        yield from added().to_batches(1 << 15)


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT (n + 1) / (total + v)), beyond 64 bits in between."""
    wide = "decimal(28,0)"
    over = F.lit(UNIT).cast("decimal(10,0)") * (n + 1).cast(wide)
    return (1 + F.call_function("div", over, (total + v).cast(wide))).cast("long")


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _excess_of(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the terms that two sources share add to their divergence.

    Rows (lang, source, term, p, p0) come with equal terms of a language side by side;
    the sources of one term are held at a time, pairs in blocks.
    """
    columns = ["lang", "source", "term", "p", "p0"]
    rest = None

    def blocks(t: pa.Table) -> Iterator[pa.RecordBatch]:
        lang, source, term = (t[c].combine_chunks().dictionary_encode() for c in columns[:3])
        ids = [x.indices.to_numpy().astype(np.int64) for x in (lang, source, term)]
        p, p0 = (t[c].to_numpy() for c in columns[3:])
        group = ids[0] * len(source.dictionary) + ids[1]
        change = np.flatnonzero(np.append(True, (ids[0][1:] != ids[0][:-1]) | (ids[2][1:] != ids[2][:-1])))
        size = np.diff(np.append(change, len(p)))
        begin, count = np.repeat(change, size), np.repeat(size, size)
        edges = np.cumsum(count)
        at = 0
        while at < len(p):
            stop = max(at + 1, int(np.searchsorted(edges, (edges[at - 1] if at else 0) + PAIRS)))
            n = count[at:stop]
            i = np.repeat(np.arange(at, stop), n)
            j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[at:stop], n)
            i, j = i[i != j], j[i != j]
            value = (_excess_of(p[i], p[j]) - _excess_of(p[i], p0[j])
                     - _excess_of(p0[i], p[j]) + _excess_of(p0[i], p0[j]))
            pair = group[i] * len(source.dictionary) + ids[1][j]
            by = np.argsort(pair, kind="stable")
            first = np.flatnonzero(np.append(True, pair[by][1:] != pair[by][:-1])) if len(by) else by
            if len(by):
                g, item = np.divmod(pair[by][first], len(source.dictionary))
                yield pa.RecordBatch.from_arrays([
                    lang.dictionary.take(pa.array(g // len(source.dictionary))),
                    source.dictionary.take(pa.array(g % len(source.dictionary))),
                    source.dictionary.take(pa.array(item)), pa.array(np.add.reduceat(value[by], first)),
                ], ["lang", "source", "item", "value"])
            at = stop

    for batch in batches:
        t = pa.Table.from_batches([batch]).select(columns)
        t = t if rest is None else pa.concat_tables([rest, t])
        last = t.slice(t.num_rows - 1)
        same = pc.and_(pc.equal(t["lang"], last["lang"][0]), pc.equal(t["term"], last["term"][0])).to_numpy()
        whole = int(np.argmax(same))
        if whole:
            yield from blocks(t.slice(0, whole))
        rest = t.slice(whole)
    if rest is not None and rest.num_rows:
        yield from blocks(rest)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of every term by group."""
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = texts.mapInArrow(count_terms, COUNTS)
    return (found.repartition("lang", "term").groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def divergences(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank: how each group departs from the other sources and its language.

    Part `pair` compares with every other source of the language over all kept terms,
    part `term` lists the terms a source uses more than its language does. Null text,
    language and source count as empty text; every row is a document of its own, also
    where ids repeat. A language without kept terms has value 0 for all its pairs; a
    language with one source has none. An empty table gives no row.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    term = Window.partitionBy("lang", "term")
    counts = term_counts(docs).withColumns({
        "in_docs": F.sum("docs").over(term), "total": F.sum("n").over(term),
        "head": F.min("source").over(term) == F.col("source")})
    kept = scratch.stage(counts.filter(F.col("in_docs") >= LEAST_DOCS).drop("docs", "in_docs"), "kept")

    langs = kept.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count_if("head").alias("v"))
    sources = kept.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    names = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    groups = (names.distinct().join(sources, ["lang", "source"], "left").join(langs, "lang", "left")
              .fillna(0, ["source_n", "lang_n", "v"]))
    nothing = F.when(F.col("v") > 0, _share(F.lit(0), F.col("source_n"), F.col("v")))
    groups = scratch.stage(groups.withColumn("p0", nothing), "groups")

    shares = scratch.stage(kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "p0", _share(F.col("n"), F.col("source_n"), F.col("v")).alias("p"),
        _share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q")), "shares")

    pair = ["lang", "source", "item"]
    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    different = F.col("source") != F.col("item")
    apart = groups.join(others, "lang").filter(different).select(
        *pair, F.coalesce(F.col("v") * _excess(F.col("p0"), F.col("q0")), F.lit(0)).alias("value"))
    p, p0, q0 = F.col("p"), F.col("p0"), F.col("q0")
    alone = (shares.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("times"))
             .join(others, "lang").filter(different).select("lang", F.inline(F.array(
                 F.struct("source", "item", (F.col("times") * (_excess(p, q0) - _excess(p0, q0))).alias("value")),
                 F.struct(F.col("item").alias("source"), F.col("source").alias("item"),
                          (F.col("times") * (_excess(q0, p) - _excess(q0, p0))).alias("value"))))))
    both = (shares.select("lang", "source", "term", "p", "p0").repartition("lang", "term")
            .sortWithinPartitions("lang", "term")
            .mapInArrow(shared_terms, "lang string, source string, item string, value long"))
    pairs = apart.unionByName(alone).unionByName(both).groupBy(*pair).agg(F.sum("value").alias("value"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                         F.row_number().over(by_value).alias("rank"))
    terms = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _excess(F.col("p"), F.col("q")).alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= TOP_TERMS)
    return pairs.unionByName(terms)
