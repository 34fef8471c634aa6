"""Benchmark decontamination by latent semantic retrieval.

Texts become sequences of the benchmark's words (case and outer punctuation ignored; any
other word is 0, as it can match nothing). Passages of WINDOW words, one every STEP, get
TF-IDF weights with document counts over all documents. A distributed randomised SVD of
all passages gives latent axes; every passage of every document is compared with every
benchmark passage by its cosine on them. Candidates are then checked word by word: the
longest common subsequence with the item, and how much of the item's answer (its last
words) the passage holds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.llm import words as W
from surveyspark.llm.scratch import Scratch

WINDOW, STEP = 32, 16   # words of a passage, words between passages
ROWS = 1024             # rows of STEP words whose vectors are added at once
ROUNDS = 3              # products with all passages that the axes come from


@dataclass(frozen=True)
class Settings:
    rank: int = 128              # latent axes
    gram_words: int = 4096       # up to so many words one pass sums a matrix of word pairs
    cosine: float = 0.5          # least cosine of a candidate ...
    energy: float = 0.2          # ... that accounts for this share of the benchmark passage;
    held: float = 0.5            # a larger share makes a candidate at any cosine
    same: float = 0.8            # common subsequence that shows a leak by itself
    alike: float = 0.6           # common subsequence that shows one together with the answer
    answer: float = 0.6          # share of the answer's words
    answer_words: int = 5
    part: float = 0.9            # common subsequence with a whole passage of a longer item
    block_items: int = 20_000    # benchmark items that one pass over the documents compares


class Benchmark:
    """Items as word ids, their passages, and the sorted words."""

    def __init__(self, ids: list, texts: list):
        hashes, at = W.words(pa.array(texts, pa.large_string()), bare=True)
        self.words = np.unique(hashes)
        coded = (np.searchsorted(self.words, hashes) + 1).astype(np.int32)
        self.items = [coded[at[i]:at[i + 1]] for i in range(len(ids))]
        self.counts = [Counter(item.tolist()) for item in self.items]
        self.ids = ids
        self.passages = [(i, k) for i, item in enumerate(self.items) for k in starts(len(item))]
        self.dtype = np.uint16 if len(self.words) < 65_000 else np.int32
        self.hint = np.zeros(1 << 20, dtype=bool)  # most other words fail here
        self.hint[(self.words & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def code(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), dtype=self.dtype)
        may = np.flatnonzero(self.hint[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, hashes[may]), len(self.words) - 1)
        ok = self.words[at] == hashes[may]
        out[may[ok]] = (at[ok] + 1).astype(self.dtype)
        return out


def starts(n: int) -> range:
    """Where passages of a text of n words begin; the last one may be shorter."""
    return range(0, max(n - WINDOW + STEP, 1), STEP) if n else range(0)


def step_rows(texts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The words laid out STEP to a row, and a last row without any; two rows make a passage.

    Returns the rows and each passage's text, place in it, first and second row.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    steps = -(-sizes // STEP)
    begin = np.append(0, np.cumsum(steps))
    ids = np.concatenate(texts)
    grid = np.zeros((begin[-1] + 1) * STEP, dtype=np.int64)
    grid[np.arange(len(ids)) + np.repeat(begin[:-1] * STEP - (np.cumsum(sizes) - sizes), sizes)] = ids
    passages = np.array([len(starts(n)) for n in sizes], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), passages)
    place = np.arange(len(text)) - np.repeat(np.cumsum(passages) - passages, passages)
    one = begin[text] + place
    two = np.where(place + 1 < steps[text], one + 1, begin[-1])
    return grid.reshape(-1, STEP), text, place, one, two


def passage_sums(vectors: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the word vectors (row 0: no word, all zeros) of all passages of some texts.

    The vectors of one column of the rows after the other are added to the rows' sums, and
    neighbouring rows make a passage. Returns the sums and each passage's text and place in it.
    """
    grid, text, place, one, two = step_rows(texts)
    sums = np.zeros((len(grid), vectors.shape[1]), dtype=np.float32)
    for a in range(0, len(grid), ROWS):
        part, out = grid[a:a + ROWS], sums[a:a + ROWS]
        for j in range(STEP):
            out += vectors[part[:, j]]
    return sums[one] + sums[two], text, place


def common_subsequence(item: np.ndarray, other: np.ndarray) -> int:
    """Length of the longest common subsequence, by one integer of match bits a row."""
    masks: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for x in other.tolist():
        hit = row & masks.get(x, 0)
        row = (row + hit | row - hit) & full
    return len(item) - row.bit_count()


def _coded(docs: DataFrame, bench) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            hashes, at = W.words(batch.column("text"), bare=True)
            ids = bench.value.code(hashes)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("mark"),
                 pa.array([ids[at[i]:at[i + 1]].tobytes() for i in range(batch.num_rows)], pa.binary())],
                ["doc", "mark", "ids"])

    named = docs.select(F.col("doc_id").alias("doc"), F.xxhash64("text").alias("mark"),
                        F.lower("text").alias("text"))
    return named.mapInArrow(rows, f"doc {kind}, mark long, ids binary")


def _document_counts(coded: DataFrame, bench) -> tuple[np.ndarray, int, int]:
    """Documents that hold each benchmark word, all documents, all passages."""
    def rows(batches):
        size = len(bench.value.words) + 1
        total, docs, passages = np.zeros(size, dtype=np.int64), 0, 0
        for batch in batches:
            for x in batch.column("ids"):
                ids = np.frombuffer(x.as_buffer(), dtype=bench.value.dtype)
                total[np.unique(ids)] += 1
                docs += 1
                passages += len(starts(len(ids)))
        total[0] = 0
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, [-1, -2])), pa.array(np.append(total[held], [docs, passages]))],
            ["id", "n"])

    found = (coded.select("ids").mapInArrow(rows, "id long, n long")
             .groupBy("id").agg(F.sum("n").alias("n")).toArrow())
    count = dict(zip(found["id"].to_pylist(), found["n"].to_pylist()))
    df = np.zeros(len(bench.value.words) + 1)
    for k, n in count.items():
        if k > 0:
            df[k] = n
    return df, count.get(-1, 0), count.get(-2, 0)


def _weights(df: np.ndarray, docs: int) -> np.ndarray:
    """Weights of the words; no word is too frequent to count, as a leak may be in most documents."""
    weight = np.log(1 + docs / np.maximum(df, 1))
    weight[0] = 0
    return weight.astype(np.float32)


def _tfidf(weight: np.ndarray, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, word (ascending in it) and value of the unit TF-IDF rows of all passages of some texts."""
    grid, _, _, one, two = step_rows(texts)
    words = np.concatenate([grid[one], grid[two]], axis=1).astype(np.int32)
    words.sort(axis=1)
    new = words > 0
    new[:, 1:] &= words[:, 1:] != words[:, :-1]
    at = np.flatnonzero(new)
    row, word = at // (2 * STEP), words.ravel()[at]
    times = np.minimum(np.append(at[1:], words.size), (row + 1) * 2 * STEP) - at
    value = (1 + np.log(times)) * weight[word]
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(one)))
    ok = norm[row] > 0
    row, word, value = row[ok], word[ok], value[ok]
    return row, word, (value / norm[row]).astype(np.float32)


def _times(rows: tuple[np.ndarray, ...], omega: np.ndarray) -> tuple[np.ndarray, int]:
    """A'A times omega for sparse rows, and their number."""
    row, word, value = rows
    out = np.zeros_like(omega)
    if not len(row):
        return out, 0
    change = np.append(True, row[1:] != row[:-1])
    product = np.add.reduceat(value[:, None] * omega[word], np.flatnonzero(change), axis=0)
    which = np.cumsum(change) - 1
    order = np.argsort(word, kind="stable")
    begin = np.flatnonzero(np.append(True, word[order][1:] != word[order][:-1]))
    out[word[order][begin]] = np.add.reduceat((value[:, None] * product[which])[order], begin, axis=0)
    return out, len(product)


def line_starts(size: int) -> np.ndarray:
    """Where the lines of a matrix begin that is kept from the diagonal on, line after line, and the end."""
    return np.append(0, np.cumsum(np.arange(size, 0, -1)))


def _add_pairs(total: np.ndarray, begin: np.ndarray, rows: tuple[np.ndarray, ...]) -> int:
    """Add sparse rows to A'A (its lines from the diagonal on); returns the number of rows."""
    row, word, value = rows
    word, value = word.astype(np.int64), value.astype(np.float64)
    np.add.at(total, begin[word], value * value)
    for d in range(1, 2 * STEP):
        at = np.flatnonzero(row[d:] == row[:-d])
        if not len(at):
            break
        np.add.at(total, begin[word[at]] + word[at + d] - word[at], value[at] * value[at + d])
    return int(np.count_nonzero(row[1:] != row[:-1])) + 1 if len(row) else 0


def _lines(matrix: Sequence[np.ndarray], n: int) -> Iterator[pa.RecordBatch]:
    """A matrix line by line (line -1: n), those without any value left out."""
    def batch(place: list[int], lines: list[bytes], counts: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int32()), pa.array(lines, pa.binary()), pa.array(counts, pa.int64())],
            ["i", "y", "n"])

    yield batch([-1], [b""], [n])
    for a in range(0, len(matrix), 64):
        some = [k for k in range(a, min(a + 64, len(matrix))) if matrix[k].any()]
        if some:
            yield batch(some, [matrix[k].astype(np.float32).tobytes() for k in some], [0] * len(some))


def _line_sums(parts: DataFrame) -> DataFrame:
    """Sums of the lines that tasks have of one matrix."""
    def rows(batches):
        total: dict[int, np.ndarray] = {}
        n = 0
        for batch in batches:
            n += sum(batch.column("n").to_pylist())
            for i, y in zip(batch.column("i").to_pylist(), batch.column("y")):
                line = np.frombuffer(y.as_buffer(), np.float32)
                if i in total:
                    total[i] += line
                else:
                    total[i] = line.astype(np.float64)
        place = sorted(total)
        for a in range(0, len(place), 64):
            some = place[a:a + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()),
                 pa.array([total[i].astype(np.float32).tobytes() for i in some], pa.binary()),
                 pa.array([n if i == -1 else 0 for i in some], pa.int64())], ["i", "y", "n"])

    return parts.repartition(16, "i").mapInArrow(rows, parts.schema)


def latent_axes(coded: DataFrame, bench, weight: np.ndarray, passages: int, s: Settings,
                scratch: Scratch) -> np.ndarray:
    """Orthonormal latent axes (words x rank) by randomised subspace iteration.

    The rows are all passages of the benchmark and of the documents; both halves get the
    same total weight, so that the axes describe the benchmark even where nothing leaked.
    Up to `gram_words` words, one pass over the documents sums the products of all pairs
    of words of a passage, and the rounds multiply with that matrix; with more words each
    round is a distributed product with all passages.
    """
    size = len(weight)
    rank = min(s.rank, size)
    # words by falling number of documents, so that most pairs fall into few lines
    order = np.append(0, 1 + np.argsort(weight[1:], kind="stable"))
    place = np.empty(size, dtype=np.int32)
    place[order] = np.arange(size)
    small = size <= s.gram_words + 1
    tasks = max(8, passages >> 20)  # about a million passages a task, as each task's sums are shuffled
    sc = coded.sparkSession.sparkContext
    table = sc.broadcast((place, weight[order]))

    def rows_of(batches) -> Iterator[tuple[np.ndarray, ...]]:
        place, weight = table.value
        for batch in W.slices(batches, 256):
            yield _tfidf(weight, [place[np.frombuffer(x.as_buffer(), dtype=bench.value.dtype)]
                                  for x in batch.column("ids")])

    def pairs(batches):
        begin = line_starts(size)
        total, n = np.zeros(begin[-1]), 0
        for rows in rows_of(batches):
            n += _add_pairs(total, begin, rows)
        yield from _lines([total[a:b] for a, b in zip(begin, begin[1:])], n)

    kind = "i int, y binary, n long"
    ids = coded.select("ids")
    if small:
        gram = scratch.stage(_line_sums(ids.coalesce(tasks).mapInArrow(pairs, kind)), "pairs")
    own = _tfidf(weight[order], [place[item] for item in bench.value.items])
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.standard_normal((size, rank)))[0].astype(np.float32)[order]
    for _ in range(ROUNDS):
        shared = sc.broadcast(basis)

        def from_gram(batches, shared=shared):
            omega, n = shared.value, 0
            total = np.zeros_like(omega)
            for batch in batches:
                n += sum(batch.column("n").to_pylist())
                batch = batch.filter(pc.greater_equal(batch.column("i"), 0))
                at = batch.column("i").to_numpy()
                lines = np.zeros((len(at), len(omega)), dtype=np.float32)
                for k, (i, y) in enumerate(zip(at, batch.column("y"))):
                    lines[k, i:] = np.frombuffer(y.as_buffer(), np.float32)
                total[at] += lines @ omega  # no line comes twice
                lines[np.arange(len(at)), at] = 0
                total += lines.T @ omega[at]
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([n])], ["y", "n"])

        def from_passages(batches, shared=shared):
            omega, n = shared.value, 0
            total = np.zeros_like(omega)
            for rows in rows_of(batches):
                more, count = _times(rows, omega)
                total += more
                n += count
            yield from _lines(total, n)

        theirs, n = np.zeros_like(basis), 0
        if small:
            for r in gram.coalesce(8).mapInArrow(from_gram, "y binary, n long").collect():  # a small matrix a task
                theirs += np.frombuffer(r.y, np.float32).reshape(basis.shape)
                n += r.n
        else:
            for r in _line_sums(ids.mapInArrow(from_passages, kind)).collect():  # one small matrix in all
                n += r.n
                if r.i >= 0:
                    theirs[r.i] = np.frombuffer(r.y, np.float32)
        ours, m = _times(own, basis)
        basis = np.linalg.qr(ours / max(m, 1) + theirs / max(n, 1))[0].astype(np.float32)
        shared.unpersist()
    if small:
        scratch.drop("pairs")
    return basis[place]


def _compare(coded: DataFrame, bench, vectors: np.ndarray, s: Settings) -> DataFrame:
    """Leaks (doc, mark, item, cosine, lcs, answer) of every passage of every document."""
    query = np.stack([vectors[bench.value.items[i][k:k + WINDOW]].sum(axis=0)
                      for i, k in bench.value.passages])
    norm = np.linalg.norm(query, axis=1)
    unit = query / np.maximum(norm, 1e-9)[:, None]
    shared = coded.sparkSession.sparkContext.broadcast((vectors, unit.T.copy(), norm))
    kind = coded.schema["doc"].dataType.simpleString()

    def leaks(texts: list[np.ndarray]) -> Iterator[tuple]:
        """(text, item, lcs, answer, cosine), the best of each text and item."""
        vectors, unit, norm = shared.value
        sums, text, place = passage_sums(vectors, texts)
        own = np.linalg.norm(sums, axis=1)
        best: dict[tuple, tuple] = {}
        live = np.flatnonzero(own >= s.energy * norm.min())
        rows = min(2048, max(64, (1 << 22) // len(norm)))  # a product of at most some 16 MB
        for a in range(0, len(live), rows):
            part = live[a:a + rows]
            dots = sums[part] @ unit
            hit = np.flatnonzero(dots >= np.minimum(s.cosine * own[part][:, None], s.held * norm[None, :]))
            row, col = hit // dots.shape[1], hit % dots.shape[1]
            close = dots[row, col] >= s.energy * norm[col]
            for r, c in zip(row[close].tolist(), col[close].tolist()):
                k = part[r]
                found = check(texts[text[k]], int(place[k]) * STEP, c, s)
                if found:
                    key, value = (int(text[k]), found[0]), (*found[1:], float(dots[r, c] / own[k]))
                    best[key] = max(best.get(key, value), value)
        for (k, item), value in best.items():
            yield k, item, *value

    def check(ids, start, col, s):
        i, k = bench.value.passages[col]
        item, count = bench.value.items[i], bench.value.counts[i]
        lo = max(0, start - k - STEP)
        region = ids[lo:start + WINDOW + len(item) - k + STEP]
        words = set(region.tolist()) & count.keys()
        # no common subsequence is longer than the item's words that the region has
        if sum(count[w] for w in words) >= s.alike * len(item):
            region = region[region > 0]
            lcs = common_subsequence(item, region) / len(item)
            tail = item[-s.answer_words:]
            answer = common_subsequence(tail, region) / len(tail)
            if lcs >= s.same or (lcs >= s.alike and answer >= s.answer):
                return i, lcs, answer
        piece = item[k:k + WINDOW]
        if len(item) > WINDOW and len(piece) == WINDOW and sum(w in words for w in piece.tolist()) >= s.part * WINDOW:
            near = ids[max(0, start - STEP):start + WINDOW + STEP]
            if common_subsequence(piece, near[near > 0]) >= s.part * WINDOW:
                region = region[region > 0]
                tail = item[-s.answer_words:]
                return (i, common_subsequence(item, region) / len(item),
                        common_subsequence(tail, region) / len(tail))
        return None

    def rows(batches):
        for batch in W.slices(batches, 256):
            found = list(leaks([np.frombuffer(x.as_buffer(), dtype=bench.value.dtype)
                                for x in batch.column("ids")]))
            if found:
                r, i, lcs, answer, cosine = zip(*found)
                at = pa.array(r, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(at), batch.column("mark").take(at),
                     pa.array([bench.value.ids[k] for k in i], pa.int64()), pa.array(cosine, pa.float64()),
                     pa.array(lcs, pa.float64()), pa.array(answer, pa.float64())],
                    ["doc", "mark", "item_id", "cosine", "lcs_share", "answer_share"])

    return coded.mapInArrow(rows, f"doc {kind}, mark long, item_id long, cosine double, "
                                  "lcs_share double, answer_share double")


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc, mark (a hash of the text), item_id, cosine, lcs_share, answer_share of each leak.

    All passages of all texts are compared. The benchmark is the query set: it is read in
    blocks of `block_items`, each with its own pass over the documents. Items with a null
    id or without words, and null or empty texts, match nothing. Rows that repeat a
    doc_id and text repeat their leaks.
    """
    spark, s = docs.sparkSession, settings
    scratch = Scratch(spark, "leaks")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).filter(
        "item_id is not null and text is not null")
    total = items.count()
    blocks = max(1, -(-total // s.block_items))
    out = None
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        part = [r for r in part if W.words(pa.array([r.text], pa.large_string()))[0].size]
        if not part:
            continue
        bench = spark.sparkContext.broadcast(Benchmark([r.item_id for r in part], [r.text for r in part]))
        coded = scratch.stage(_coded(docs, bench), f"coded{b}")
        df, n_docs, passages = _document_counts(coded, bench)
        weight = _weights(df, n_docs)
        vectors = weight[:, None] * latent_axes(coded, bench, weight, passages, s, scratch)
        found = scratch.stage(_compare(coded, bench, vectors.astype(np.float32), s), f"found{b}")
        scratch.drop(f"coded{b}")
        out = found if out is None else out.union(found)
    if out is None:
        kind = docs.schema["doc_id"].dataType.simpleString()
        out = spark.createDataFrame([], f"doc {kind}, mark long, item_id long, cosine double, "
                                        "lcs_share double, answer_share double")
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id and item_id of every leak, with its best cosine, lcs_share and answer_share."""
    return (find_leaks(docs, benchmark, settings).groupBy(F.col("doc").alias("doc_id"), "item_id")
            .agg(*[F.max(c).alias(c) for c in ("cosine", "lcs_share", "answer_share")]))


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """`docs` without the documents that hold a benchmark item; all columns are kept."""
    found = find_leaks(docs, benchmark, settings).select(
        F.col("doc").alias("__doc"), F.col("mark").alias("__mark")).distinct()
    names = docs.columns
    return (docs.withColumn("__text_hash", F.xxhash64("text"))
            .join(found, F.col("doc_id").eqNullSafe(F.col("__doc"))
                  & (F.col("__text_hash") == F.col("__mark")), "left_anti").select(*names))
