"""Substring dedup by sliding sentence spans.

A text's sentences end at ., ! or ? before white space and at line ends. Every run of
consecutive sentences that just reaches `min_words` words, counted from its first
sentence onwards and from its last one backwards, is hashed by its words (A-Z
lower-cased, white space ignored). Of the places of a hash in all documents the first, by
(doc_id, position), stays; sentences that any other place covers are removed. As both
directions are hashed, a repeated passage of at least `min_words` words is covered to
both of its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyspark.llm import bloom
from surveyspark.llm import words as W
from surveyspark.llm.scratch import Scratch

ROWS = 256  # texts handled at once in a task
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?")] = True
_CLOSE = np.zeros(256, dtype=bool)
_CLOSE[list(b"\"')]")] = True


class Sentences:
    """Sentences of an Arrow text column: spans of words and of bytes."""

    def __init__(self, column: pa.Array):
        column = W.strings(column)
        self.raw, self.rows = W.buffers(column)
        self.hashes, at, start, end = W.words(column, spans=True)
        n = len(self.hashes)
        self.row_start = np.zeros(len(self.rows), dtype=np.int64)
        if not n:
            self.first_word = self.last_word = self.row = self.byte_start = np.empty(0, np.int64)
            return
        tail = end - 1
        closed = _CLOSE[self.raw[tail]] & (tail > start)
        stops = _STOP[self.raw[tail]] | (closed & _STOP[self.raw[np.maximum(tail - 1, 0)]])
        lines = np.flatnonzero(self.raw == 10)
        after = np.append(start[1:], len(self.raw))
        stops |= np.searchsorted(lines, after) > np.searchsorted(lines, end)
        stops[at[1:][at[1:] > at[:-1]] - 1] = True  # a row's last word
        self.last_word = np.flatnonzero(stops) + 1  # one past it
        self.first_word = np.append(0, self.last_word[:-1])
        self.row = np.searchsorted(at, self.first_word, side="right") - 1
        self.row_start = np.searchsorted(self.row, np.arange(len(self.rows)))
        self.byte_start = start[self.first_word]

    def runs(self, min_words: int) -> tuple[np.ndarray, ...]:
        """Row, first and last sentence (in its row) and hash of every run."""
        a, b, m = self.first_word, self.last_word, len(self.first_word)
        if not m:
            empty = np.empty(0, np.int64)
            return empty, empty, empty, np.empty(0, np.uint64)
        every = np.arange(m)
        last = np.searchsorted(b, a + min_words)
        ok = last < m
        forward = np.stack([every[ok], last[ok]])
        first = np.searchsorted(a, b - min_words, side="right") - 1
        ok = first >= 0
        backward = np.stack([first[ok], every[ok]])
        first, last = _unique_pairs(forward, backward, m)
        inside = self.row[first] == self.row[last]
        first, last = first[inside], last[inside]
        h = W.span_hashes(self.hashes, a[first], b[last])
        row = self.row[first]
        return row, first - self.row_start[row], last - self.row_start[row], h

    def without(self, row: int, gone: np.ndarray) -> str:
        """The row's text without the sentences at the given places."""
        lo, hi = self.row_start[row], self.row_start[row + 1]
        text = self.raw[self.rows[row]:self.rows[row + 1]]
        cut = np.append(self.byte_start[lo:hi], self.rows[row + 1]) - self.rows[row]
        keep = np.ones(hi - lo, dtype=bool)
        keep[gone[gone < hi - lo]] = False
        parts = [text[:cut[0]]] if len(cut) > 1 else [text]
        parts += [text[cut[j]:cut[j + 1]] for j in np.flatnonzero(keep)]
        return b"".join(p.tobytes() for p in parts).decode("utf-8", "replace").rstrip()


def _unique_pairs(one: np.ndarray, two: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    code = np.unique(np.concatenate([one[0] * m + one[1], two[0] * m + two[1]]))
    return code // m, code % m


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, ROWS):
        yield batch.slice(k, ROWS)


def _runs(docs: DataFrame, min_words: int, keep=None) -> DataFrame:
    """h, doc, mark, first, last of all runs; with `keep`, of those that pass the filter."""
    shared = docs.sparkSession.sparkContext.broadcast(keep) if keep else None

    def rows(batches):
        for batch in batches:
            for part in _slices(batch):
                row, first, last, h = Sentences(part.column("text")).runs(min_words)
                if shared is not None:
                    ok = bloom.passes(*shared.value, h)
                    row, first, last, h = row[ok], first[ok], last[ok], h[ok]
                if not len(row):
                    continue
                if shared is None:
                    yield pa.RecordBatch.from_arrays([pa.array(W.as_long(h))], ["h"])
                    continue
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.as_long(h)), part.column("doc").take(at), part.column("mark").take(at),
                     pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    ["h", "doc", "mark", "first", "last"])

    if keep is None:
        return docs.select("text").mapInArrow(rows, "h long")
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("mark"), "text")
    return named.mapInArrow(rows, f"h long, doc {kind}, mark long, first int, last int")


def repeated_sentences(docs: DataFrame, min_words: int = 25, scratch: Scratch | None = None) -> DataFrame:
    """doc, mark (a hash of the text) and gone: the places of the sentences to remove.

    Rows with the same doc_id and text count as one document.
    """
    scratch = scratch or Scratch(docs.sparkSession, "sentences")
    docs = docs.select("doc_id", "text")
    often = scratch.stage(_runs(docs, min_words).groupBy("h").count().filter("count > 1").select("h"), "often")
    places = _runs(docs, min_words, bloom.build(often, "h")).join(often.hint("shuffle_hash"), "h")
    places = scratch.stage(places, "places")
    # written, so that the join has a shuffle on both sides and a hot hash can be split
    first = scratch.stage(places.groupBy("h").agg(F.min(F.struct("doc", "mark", "first")).alias("kept")), "first")
    other = (places.join(first, "h")
             .filter(~F.struct("doc", "mark", "first").eqNullSafe(F.col("kept"))))
    return (other.select("doc", "mark", "first", "last").distinct().groupBy("doc", "mark")
            .agg(F.flatten(F.collect_list(F.sequence("first", "last"))).alias("gone"))
            .withColumn("gone", F.array_distinct("gone")))


def dedup_sentences(docs: DataFrame, min_words: int = 25) -> DataFrame:
    """`docs` without repeated sentence spans, with n_removed, the sentences cut.

    All other columns are kept; n_chars, where there is one, is counted anew for a text
    that changed. Texts without a repeated span come back unchanged, nulls as null. Rows
    with a null doc_id come before all others in the order that says which place is first.
    A text whose sentences are all removed becomes empty.
    """
    marks = repeated_sentences(docs, min_words).select(
        F.col("doc").alias("__doc"), F.col("mark").alias("__mark"), F.col("gone").alias("__gone"))
    joined = (docs.withColumn("__text_hash", F.xxhash64("text"))
              .join(marks, F.col("doc_id").eqNullSafe(F.col("__doc"))
                    & (F.col("__text_hash") == F.col("__mark")), "left")
              .drop("__doc", "__mark", "__text_hash"))
    names = [c for c in docs.columns if c != "n_removed"]
    joined = joined.select(*names, "__gone")

    def cut(batches):
        for batch in batches:
            for part in _slices(batch):
                gone = part.column("__gone")
                text, removed = part.column("text"), np.zeros(part.num_rows, dtype=np.int64)
                if gone.null_count < part.num_rows:
                    hit = [i for i, x in enumerate(gone.is_valid().to_pylist()) if x]
                    found, text = Sentences(text.take(pa.array(hit))), text.to_pylist()
                    for k, i in enumerate(hit):
                        places = np.unique(np.array(gone[i].as_py()))
                        text[i], removed[i] = found.without(k, places), len(places)
                    text = pa.array(text, part.column("text").type)
                columns = [text if c == "text" else part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(removed)], [*names, "n_removed"])

    schema = T.StructType([joined.schema[c] for c in names] + [T.StructField("n_removed", T.LongType())])
    out = joined.mapInArrow(cut, schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out
