"""Best-fit packing of documents into sequences by the sum-of-squares rule.

A piece goes to the open bin, or a new one, after which the sum over residual gaps of
the squared number of open bins with that gap is smallest. Pieces are dealt at random
over shards of about SHARD pieces; each shard packs its own, longest first, in one task.
Bins that a shard leaves less than FULL full are opened again, and their pieces are
packed in a second round, again in shards of about SHARD pieces, and so on until one
shard is left. Where a round leaves hardly fewer pieces than it got, the lengths do not
fill bins in any shard: these bins stay, so no task packs much more than SHARD pieces.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.llm import words as W
from surveyspark.llm.scratch import Scratch
from surveyspark.llm.tokens import Encoder

SHARD, FULL = 20_000, 0.98
ROWS = 256  # texts encoded at once


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all but the first have the full size."""
    first = length % size or min(length, size)
    return [(0, first)] + [(a, size) for a in range(first, length, size)]


def sum_of_squares(lengths: np.ndarray, size: int) -> np.ndarray:
    """Bin number of every piece, placed in the given order.

    Placing a piece of length x into a bin of gap g changes the sum of squares by
    2 * (open[g - x] - open[g]) + 2, less for a bin it closes (gap 0 is not counted) or
    opens. Ties go to the smallest gap.
    """
    opened = np.zeros(size + 1, dtype=np.int64)       # bins by gap; 0 and size stay 0
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    out, bins = np.empty(len(lengths), dtype=np.int64), 0
    far = np.iinfo(np.int64).max
    for i, x in enumerate(lengths.tolist()):
        now, then = opened[x:], opened[:size - x + 1]
        cost = np.where(now > 0, 2 * (then - now) + 2, far)
        if now[0]:
            cost[0] = 1 - 2 * now[0]
        cost[-1] = 2 * then[-1] + 1 if x < size else 0
        gap = x + int(np.argmin(cost))
        if gap == size:
            bins += 1
            which = bins - 1
        else:
            which = stacks[gap].pop()
            opened[gap] -= 1
        if gap > x:
            stacks[gap - x].append(which)
            opened[gap - x] += 1
        out[i] = which
    return out


def _pieces(docs: DataFrame, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of all pieces."""
    def rows(batches):
        encoder = Encoder(vocabulary)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                doc, out = [], []
                for i, ids in enumerate(encoder.encode(W.strings(part.column("text")))):
                    ids = np.append(ids, np.uint32(end_id))
                    for p, (start, n) in enumerate(cut(len(ids), size)):
                        doc.append(i)
                        out.append((p, start, n, zlib.crc32(ids[start:start + n].astype("<u4").tobytes())))
                piece, start, length, crc = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        rows, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def _pack_round(pieces: DataFrame, round_no: int, shards: int, size: int) -> DataFrame:
    """uid, length, bin, offset, done of each piece; a bin is named by its first piece, `done` bins stay."""
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        length = pdf["length"].to_numpy()
        where = sum_of_squares(length, size)
        order = np.argsort(where, kind="stable")
        filled = np.cumsum(length[order])
        first = np.append(True, where[order][1:] != where[order][:-1])
        base = (filled - length[order])[first][np.cumsum(first) - 1]
        offset = np.empty(len(pdf), dtype=np.int64)
        offset[order] = filled - length[order] - base
        total = np.bincount(where, weights=length)
        done = np.ones(len(pdf), dtype=bool) if shards == 1 else total[where] >= FULL * size
        uid = pdf["uid"].to_numpy()
        bin_of = np.empty(len(pdf), dtype=np.int64)
        bin_of[order] = uid[order][first][np.cumsum(first) - 1]
        return pd.DataFrame({"uid": uid, "length": length, "bin": bin_of, "offset": offset, "done": done})

    dealt = pieces.select("uid", "length").withColumn(
        "shard", F.pmod(F.xxhash64("uid", F.lit(round_no)), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(
        pack, "uid long, length long, bin long, offset long, done boolean")


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.

    A document is its token ids and then `end_id`; a null text has only that. Only a
    document of more than `size` ids is cut. Every row of docs gets its own pieces, also
    rows with a null or repeated doc_id. sequence_id is unique to a sequence; pieces fill
    it from offset 0 without gaps.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.stage(
        _pieces(docs, vocabulary, end_id, size).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.filter(F.col("length") == size).select(
        "uid", "length", F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias("done"))
    rest = pieces.filter(F.col("length") < size)
    placed, shards, round_no = [full], max(1, math.ceil(rest.count() / SHARD)), 1
    while True:
        packed = scratch.stage(_pack_round(rest, round_no, shards, size), f"round{round_no}")
        placed.append(packed.filter("done"))
        rest = packed.filter("not done")
        fewer = math.ceil(rest.count() / SHARD)
        if fewer > 0.9 * shards:  # these lengths do not fill bins better in any shard: they stay as they are
            placed.append(rest)
            break
        if not fewer:
            break
        shards, round_no = fewer, round_no + 1
    everything = placed[0]
    for more in placed[1:]:
        everything = everything.unionByName(more)
    # a piece ends in one bin only, so its first piece names a sequence uniquely
    where = everything.select("uid", F.col("bin").alias("sequence_id"), "offset")
    return pieces.join(where, "uid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
