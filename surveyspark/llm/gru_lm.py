"""A gated recurrent language model over words, trained and applied in numpy on Spark.

Words: A-Z lower-cased runs outside x20 and x09-x0D, then one end token per text. Counts
of all training tokens come from one grouped sum. The output softmax is factored by
class: the SHORTLIST most frequent words in classes of CLASS words by frequency, all
other words in SHAPES classes by the form of the word. A class's probability, and a
shortlist word's within its class, come from the recurrent state; another word's within
its class from the counts, add-one smoothed with one place for all unseen words.

Training is truncated back-propagation over windows of WINDOW tokens, the state carried
from window to window, in tasks; every training document is learned from in one of the
rounds. After a round the tasks' parameters are averaged, weighted by tokens. Scoring carries the state
through the whole of every text.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.llm import words as W
from surveyspark.llm.scratch import Scratch

SHORTLIST, CLASS, SHAPES = 1024, 32, 32
HEAD = 1 << 17        # most words whose counts every task holds; the others are joined
HIDDEN, WINDOW = 16, 32
BATCH = 512           # texts that advance together in scoring
SEGMENT = 512         # symbols over which training carries a state; scoring carries it to the text's end
ROWS = 2048           # states whose output layer is computed at once in scoring: they stay in cache
HOLD = 1 << 21        # tokens that a task gathers, so that texts of like length advance together
BLOCK = 1 << 22       # tokens of a task that are counted together
END = np.uint64(0x9AE16A3B2F90404F)
LOW = np.uint64((1 << 20) - 1)
CLASSES = SHORTLIST // CLASS + SHAPES


@dataclass(frozen=True)
class Settings:
    rounds: int = 3           # which share the training documents among them
    rate: float = 0.03        # of the first round; it halves each round
    train_batch: int = 64


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and shape classes of all tokens (each text's end included), row offsets."""
    column = W.strings(column)
    hashes, at, start, end = W.words(column, spans=True)
    raw, _ = W.buffers(column)
    high = raw >= 0x80
    if len(raw):
        seen = np.maximum.accumulate(np.where(high, np.arange(len(raw)), -1))
        last = seen[end - 1] if len(end) else np.empty(0, np.int64)
        tail = raw[np.maximum(end - 2, start)].astype(np.int64) * 31 + raw[end - 1]
        shape = np.where(last >= start, raw[np.maximum(last, 0)] % 8, 8 + tail % (SHAPES - 8))
    else:
        shape = np.empty(0, np.int64)
    stops = at[1:]
    return (np.insert(hashes, stops, END), np.insert(shape.astype(np.int64), stops, 0),
            at + np.arange(len(at)))


def held_out() -> F.Column:
    """Whether crc32 of the doc_id as text leaves 2 when divided by 7; false for a null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """h, shape, n: training tokens by word, over all training documents."""
    def rows(batches):
        held, size = [], 0
        for batch in W.slices(batches):
            h, shape, _ = tokens(batch.column("text"))
            held.append((h, shape))
            size += len(h)
            if size >= BLOCK:
                yield count(held)
                held, size = [], 0
        if held:
            yield count(held)

    def count(held):
        h = np.concatenate([x for x, _ in held])
        values, first, n = np.unique(h, return_index=True, return_counts=True)
        shape = np.concatenate([x for _, x in held])[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(W.as_long(values)), pa.array(shape.astype(np.int32)), pa.array(n.astype(np.int64))],
            ["h", "shape", "n"])

    return (docs.filter(~held_out()).select("text").mapInArrow(rows, "h long, shape int, n long")
            .groupBy("h").agg(F.min("shape").alias("shape"), F.sum("n").alias("n")))


class Vocabulary:
    """Counts of the head words, shortlist slots and totals by class."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("n"), F.count("*")).first()
        self.tokens, self.distinct = int(total[0] or 0), int(total[1])
        level = F.floor(F.log2("n") * 8)
        levels = sorted(((r[0], r[1]) for r in counts.groupBy(level).count().collect()), reverse=True)
        size, floor = 0, None
        for value, n in levels:
            if size + n > HEAD and floor is not None:
                break
            size, floor = size + n, value
        end = int(END.astype(np.int64))
        head = counts.filter((level >= (floor if floor is not None else 0)) | (F.col("h") == end)).toArrow()
        h, n = head["h"].to_numpy().view(np.uint64), head["n"].to_numpy()
        shape = head["shape"].to_numpy()
        order = np.argsort(h)
        self.h, self.n, shape = h[order], n[order], shape[order]
        rank = np.lexsort((self.h, -self.n, self.h != END))[:SHORTLIST]  # the end token comes first
        rank = rank[np.argsort(-self.n[rank], kind="stable")]
        self.slot = np.full(len(self.h), -1, dtype=np.int64)
        self.slot[rank] = np.arange(len(rank))
        self.short_n = np.zeros(SHORTLIST)
        self.short_n[:len(rank)] = self.n[rank]
        sums = counts.groupBy("shape").agg(F.sum("n"), F.count("*")).collect()
        self.shape_n, self.shape_v = np.zeros(SHAPES), np.zeros(SHAPES)
        for s, n_all, v in sums:
            self.shape_n[s], self.shape_v[s] = n_all, v
        np.subtract.at(self.shape_n, shape[rank], self.n[rank])
        np.subtract.at(self.shape_v, shape[rank], 1)
        self.index()

    def index(self) -> None:
        """A place in the head for the low bits of a hash, and where several words share them."""
        low = (self.h & LOW).astype(np.int64)
        self.place = np.zeros(int(LOW) + 1, dtype=np.int32)
        self.place[low] = np.arange(len(low))
        self.shared = np.bincount(low, minlength=int(LOW) + 1) > 1

    def look_up(self, h: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, ...]:
        """Symbol and head count (-1: not in the head) of every token."""
        if not len(self.h):
            return SHORTLIST + shape, np.full(len(h), -1)
        low = (h & LOW).astype(np.int64)
        at, again = self.place[low], np.flatnonzero(self.shared[low])
        at[again] = np.minimum(np.searchsorted(self.h, h[again]), len(self.h) - 1)
        hit = self.h[at] == h
        slot = np.where(hit, self.slot[at], -1)
        return np.where(slot >= 0, slot, SHORTLIST + shape), np.where(hit, self.n[at], -1)


def new_parameters(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """Small random weights; the biases give the counts' probabilities."""
    rng = np.random.default_rng(11)
    f32 = np.float32
    in_class = vocabulary.short_n.reshape(-1, CLASS)
    by_class = np.concatenate([in_class.sum(axis=1), vocabulary.shape_n + vocabulary.shape_v]) + 1
    words = np.where(in_class > 0, in_class, 1e-9)
    return {
        "x": (rng.standard_normal((SHORTLIST + SHAPES, 3 * HIDDEN)) * 0.3).astype(f32),
        "u": (rng.standard_normal((HIDDEN, 3 * HIDDEN)) / math.sqrt(HIDDEN)).astype(f32),
        "c": (rng.standard_normal((HIDDEN, CLASSES)) * 0.05).astype(f32),
        "cb": np.log(by_class / by_class.sum()).astype(f32),
        "w": np.zeros((SHORTLIST // CLASS, HIDDEN, CLASS), dtype=f32),
        "wb": np.log(words / words.sum(axis=1, keepdims=True)).astype(f32),
    }


def _pack(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _unpack(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


class Recurrence:
    """The recurrent step of some parameters; gates are kept as their negatives until the logistic function."""

    def __init__(self, p):
        self.x = p["x"]
        self.u = p["u"].copy()
        self.u[:, :2 * HIDDEN] *= -1

    def inputs(self, symbols: np.ndarray) -> np.ndarray:
        a = self.x.take(symbols, axis=0)
        np.negative(a[..., :2 * HIDDEN], out=a[..., :2 * HIDDEN])
        return a

    def step(self, a, h, b, gates, new, out) -> None:
        """State after symbols of the inputs a into `out`; b, gates and new are what the backward pass needs."""
        k = 2 * HIDDEN
        np.matmul(h, self.u, out=b)
        np.add(a[:, :k], b[:, :k], out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[:, HIDDEN:], b[:, k:], out=new)
        new += a[:, k:]
        np.tanh(new, out=new)
        np.subtract(h, new, out=out)
        out *= gates[:, :HIDDEN]
        out += new


def _step(p, symbols, h):
    """State after the symbols, and what the backward pass needs."""
    n, kind = len(symbols), p["u"].dtype
    b, gates = np.empty((n, 3 * HIDDEN), kind), np.empty((n, 2 * HIDDEN), kind)
    new, out = np.empty((2, n, HIDDEN), kind)
    recurrence = Recurrence(p)
    recurrence.step(recurrence.inputs(symbols), h, b, gates, new, out)
    return out, (gates, new, b[:, 2 * HIDDEN:])


def _output(p, h, symbols, grads=None):
    """Natural log-probability of class and shortlist word of each symbol, given states.

    With `grads`, the loss's gradients are added there and those of the states returned.
    """
    symbols = symbols.astype(np.int64)
    cls = np.where(symbols < SHORTLIST, symbols // CLASS, SHORTLIST // CLASS + symbols - SHORTLIST)
    logit = p["c"].T @ h.T  # a row for each class: sums down the columns are quick
    logit += p["cb"][:, None]
    logit -= logit.max(axis=0)
    every = np.arange(len(h))
    chosen = logit[cls, every]
    e = np.exp(logit, out=logit)
    total = e.sum(axis=0)
    logp = (chosen - np.log(total)).astype(np.float64)
    dh = None
    if grads is not None:
        e /= total
        e[cls, every] -= 1
        grads["c"] += (e @ h).T
        grads["cb"] += e.sum(axis=1)
        dh = (p["c"] @ e).T
    own = np.flatnonzero(symbols < SHORTLIST)
    own = own[np.argsort(cls[own].astype(np.int16), kind="stable")]  # by class, a radix sort
    borders = np.searchsorted(cls[own], np.arange(SHORTLIST // CLASS + 1)).tolist()
    spans = [(k, slice(a, b)) for k, (a, b) in enumerate(zip(borders, borders[1:])) if b > a]
    mine = h.take(own, axis=0)
    by_row = np.empty((len(own), CLASS), dtype=p["w"].dtype)
    for k, at in spans:
        np.matmul(mine[at], p["w"][k], out=by_row[at])
    by_row += p["wb"].take(cls[own], axis=0)
    logit = by_row.T.copy()  # a row for each word of a class
    logit -= logit.max(axis=0)
    every, word = np.arange(len(own)), symbols[own] % CLASS
    chosen = logit[word, every]
    e = np.exp(logit, out=logit)
    total = e.sum(axis=0)
    logp[own] += chosen - np.log(total)
    if grads is not None:
        e /= total
        e[word, every] -= 1
        by_row[...] = e.T
        back = np.empty_like(mine)
        for k, at in spans:
            part = by_row[at]
            grads["w"][k] += mine[at].T @ part
            np.matmul(part, p["w"][k].T, out=back[at])
        if spans:
            grads["wb"][[k for k, _ in spans]] += np.add.reduceat(by_row, [at.start for _, at in spans], axis=0)
        dh[own] += back
    return logp, dh


def _ranked(sizes: np.ndarray, batch: int):
    """Texts in groups of similar length, longest first."""
    order = np.argsort(-sizes, kind="stable")
    for a in range(0, len(order), batch):
        yield order[a:a + batch]


def score_texts(p, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Natural log-probability of each text's symbols, the state carried to its end."""
    sizes = np.diff(at)
    out = np.zeros(len(sizes))
    recurrence = Recurrence(p)
    for group in _ranked(sizes, BATCH):
        size, begin = sizes[group], at[group]
        longest = int(size[0]) if len(size) else 0
        h, after, new = np.zeros((3, len(group), HIDDEN), dtype=np.float32)
        b, gates = np.empty((len(group), 3 * HIDDEN), np.float32), np.empty((len(group), 2 * HIDDEN), np.float32)
        lives = np.searchsorted(-size, -np.arange(longest), side="left")  # texts longer than t
        states, targets, who, rows = [], [], [], 0
        for t in range(longest):
            live = int(lives[t])
            now = symbols[begin[:live] + t]
            states.append(h[:live].copy())
            targets.append(now)
            who.append(live)
            rows += live
            recurrence.step(recurrence.inputs(now), h[:live], b[:live], gates[:live], new[:live], after[:live])
            h, after = after, h
            if rows >= ROWS or t == longest - 1:
                logp, _ = _output(p, np.concatenate(states), np.concatenate(targets))
                whose = np.concatenate([np.arange(n) for n in who])
                out[group] += np.bincount(whose, logp, minlength=len(group))
                states, targets, who, rows = [], [], [], 0
    return out


class Trainer:
    """Adam over windows; one for each task and round."""

    def __init__(self, p, rate: float):
        self.p, self.rate, self.step = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def window(self, symbols: np.ndarray, mask: np.ndarray, h: np.ndarray) -> np.ndarray:
        """One update from a window (texts x time); returns the state after it."""
        p, g = self.p, {k: np.zeros_like(v) for k, v in self.p.items()}
        n, length = symbols.shape
        k, kind, symbols = 2 * HIDDEN, p["u"].dtype, symbols.T
        recurrence = Recurrence(p)
        inputs = recurrence.inputs(symbols)
        states = np.empty((length + 1, n, HIDDEN), kind)
        gates = np.empty((length, n, k), kind)
        b, new = np.empty((length, n, 3 * HIDDEN), kind), np.empty_like(states[1:])
        states[0] = h
        for t in range(length):
            recurrence.step(inputs[t], states[t], b[t], gates[t], new[t], states[t + 1])
        live = mask.T.ravel()
        before = states[:-1]
        flat = before.reshape(-1, HIDDEN)
        d_out = np.zeros_like(flat)
        at = np.flatnonzero(live)
        _, d_live = _output(p, flat.take(at, axis=0), symbols.ravel()[at], g)
        d_out[at] = d_live
        d_out = d_out.reshape(length, n, HIDDEN)
        # the derivatives of all steps at once; the loop back only carries dh through them
        z, r = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
        to_n = (1 - z) * (1 - new * new)
        to_b = np.empty((length, n, 3, HIDDEN), kind)  # from dh to the gradient of h @ u
        np.multiply((before - new) * z, 1 - z, out=to_b[:, :, 0])
        np.multiply(to_n * b[:, :, k:], r * (1 - r), out=to_b[:, :, 1])
        np.multiply(to_n, r, out=to_b[:, :, 2])
        db = to_b
        dh, back = np.zeros((2, n, HIDDEN), kind)
        u, dhs = p["u"].T.copy(), np.empty_like(new)
        for t in range(length - 1, -1, -1):
            dhs[t] = dh
            db[t] *= dh[:, None, :]
            np.matmul(db[t].reshape(n, 3 * HIDDEN), u, out=back)
            dh *= z[t]
            dh += back
            dh += d_out[t]
        db = db.reshape(-1, 3 * HIDDEN)
        g["u"] += flat.T @ db
        db[:, k:] = (dhs * to_n).reshape(-1, HIDDEN)  # now the gradient of the inputs
        which = symbols.ravel()
        order = np.argsort(which, kind="stable")
        first = np.flatnonzero(np.append(True, which[order][1:] != which[order][:-1]))
        g["x"][which[order][first]] = np.add.reduceat(db.take(order, axis=0), first, axis=0)
        count = max(int(live.sum()), 1)
        norm = math.sqrt(sum(float((v * v).sum()) for v in g.values())) / count
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-9)) / count)
        self.step += 1
        rate = self.rate * math.sqrt(1 - 0.999 ** self.step) / (1 - 0.9 ** self.step)
        for k, v in g.items():
            v *= scale
            self.m[k] += np.float32(0.1) * (v - self.m[k])
            self.v[k] += np.float32(0.001) * (v * v - self.v[k])
            p[k] -= np.float32(rate) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-8))
        return states[-1]

    def texts(self, symbols: np.ndarray, at: np.ndarray, batch: int) -> None:
        """Windows over all texts; a long one is several sequences of SEGMENT symbols at most."""
        sizes = np.diff(at)
        parts = -(-sizes // SEGMENT)
        skip = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT
        begin, sizes = np.repeat(at[:-1], parts) + skip, np.minimum(np.repeat(sizes, parts) - skip, SEGMENT)
        for group in _ranked(sizes, batch):
            size, h = sizes[group], np.zeros((len(group), HIDDEN), dtype=np.float32)
            for t0 in range(0, int(size[0]), WINDOW):
                live = int(np.searchsorted(-size, -t0, side="left"))
                span = np.arange(t0, t0 + WINDOW)
                mask = span[None, :] < size[:live, None]
                place = np.minimum(begin[group[:live], None] + span[None, :], len(symbols) - 1)
                h = self.window(symbols[place], mask, h[:live])


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and row offsets of several slices as one."""
    sizes = np.concatenate([np.diff(at) for _, at in parts])
    return np.concatenate([x for x, _ in parts]), np.append(0, np.cumsum(sizes))


def train(docs: DataFrame, vocabulary: Vocabulary, s: Settings) -> dict[str, np.ndarray]:
    """Parameters after s.rounds rounds of training in the tasks and averaging.

    Each round takes other training documents, by a hash of the doc_id and text; together
    the rounds take all of them, at any size.
    """
    p = new_parameters(vocabulary)
    sc = docs.sparkSession.sparkContext
    learned = docs.filter(~held_out()).select("doc_id", "text")
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(s.rounds))
    known = sc.broadcast(vocabulary)
    for k in range(s.rounds):
        shared = sc.broadcast(p)
        rate = s.rate / 2 ** k

        def rows(batches, shared=shared, rate=rate):
            trainer, held, size, seen = None, [], 0, 0

            def learn():
                trainer.texts(*_joined(held), s.train_batch)
                return size

            for batch in W.slices(batches, 1024):
                trainer = trainer or Trainer({n: v.copy() for n, v in shared.value.items()}, rate)
                h, shape, at = tokens(batch.column("text"))
                held.append((known.value.look_up(h, shape)[0].astype(np.uint16), at))
                size += len(h)
                if size >= HOLD:
                    seen += learn()
                    held, size = [], 0
            if held:
                seen += learn()
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([float(seen)]), pa.array([(_pack(trainer.p) * seen).astype(np.float32).tobytes()],
                                                       pa.binary())], ["n", "p"])

        def add(pdf: pd.DataFrame) -> pd.DataFrame:
            flat = sum(np.frombuffer(v, np.float32).astype(np.float64) for v in pdf["p"])
            return pd.DataFrame({"n": [pdf["n"].sum()], "p": [flat.astype(np.float32).tobytes()]})

        found = learned.filter(turn == k).select("text").mapInArrow(rows, "n double, p binary")
        groups = max(1, math.isqrt(found.rdd.getNumPartitions()))
        sums = (found.groupBy(F.pmod(F.xxhash64("p"), F.lit(groups)).alias("g"))
                .applyInPandas(add, "n double, p binary").collect())
        if sums:
            seen = sum(r.n for r in sums)
            p = _unpack(sum(np.frombuffer(r.p, np.float32).astype(np.float64) for r in sums) / seen, p)
        shared.unpersist()
    return p


def score_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    A null text is empty: one end token. A null doc_id is not held out. base_score is the
    add-one unigram score of the tokens, score the model's log10-probability. Without any
    training token every word has probability 1 / (N + V + 1) = 1 in base_score.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "gru")
    docs = docs.select("doc_id", "text")
    counts = scratch.stage(word_counts(docs), "counts")
    vocabulary = Vocabulary(counts)
    p = train(docs, vocabulary, settings)
    shared = spark.sparkContext.broadcast((vocabulary, p))
    room = np.log10(vocabulary.shape_n + vocabulary.shape_v + 1)

    names = ["doc_id", "held_out", "n_tokens", "known", "logs", "model", "words", "times"]

    def rows(batches):
        vocabulary, p = shared.value
        held, size = [], 0

        def scored():
            symbols, at = _joined([x for x, _, _ in held])
            model, a = score_texts(p, symbols, at) / math.log(10), 0
            for _, columns, rest in held:
                b = a + len(rest)
                yield pa.RecordBatch.from_arrays(
                    [*columns[:5], pa.array(model[a:b] + rest), *columns[5:]], names)
                a = b

        for batch in W.slices(batches, 1024):
            h, shape, at = tokens(batch.column("text"))
            symbols, n = vocabulary.look_up(h, shape)
            row = np.repeat(np.arange(batch.num_rows), np.diff(at))
            total = lambda x: np.bincount(row, x, minlength=batch.num_rows)
            log_n, other = np.log10(np.maximum(n, 0) + 1.0), symbols >= SHORTLIST
            away = np.flatnonzero(n < 0)
            key = np.stack([row[away], W.as_long(h[away])])
            order = np.lexsort((key[1], key[0]))
            key = key[:, order]
            first = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))) if len(away) else away
            times = np.diff(np.append(first, len(away)))
            offsets = pa.array(np.append(0, np.cumsum(
                np.bincount(key[0, first], minlength=batch.num_rows))).astype(np.int32))
            held.append(((symbols.astype(np.uint16), at), [
                batch.column("doc_id"), batch.column("held_out"), pa.array(np.diff(at)),
                pa.array(total(n > 0).astype(np.int64)), pa.array(total(log_n)),
                pa.ListArray.from_arrays(offsets, pa.array(key[1, first])),
                pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
            ], total(np.where(other, log_n - room[np.where(other, symbols - SHORTLIST, 0)], 0.0))))
            size += len(h)
            if size >= HOLD:
                yield from scored()
                held, size = [], 0
        if held:
            yield from scored()

    kind = docs.schema["doc_id"].dataType.simpleString()
    local = scratch.stage(
        docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
            rows, f"doc_id {kind}, held_out boolean, n_tokens long, known long, logs double, model double, "
                  "words array<long>, times array<long>")
        .withColumn("uid", F.monotonically_increasing_id()), "local")
    away = local.select("uid", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "uid", F.col("w.words").alias("h"), F.col("w.times").alias("m"))
    found = (away.join(counts.select("h", "n"), "h").groupBy("uid")
             .agg(F.sum("m").alias("more"), F.sum(F.col("m") * F.log10(F.col("n") + 1.0)).alias("more_logs")))
    full = math.log10(vocabulary.tokens + vocabulary.distinct + 1)
    more = F.coalesce("more_logs", F.lit(0.0))
    return local.join(found, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * F.lit(full)).alias("base_score"),
        (F.col("model") + more).alias("score"))
