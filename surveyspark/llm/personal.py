"""Personal data in texts: fixed patterns, and a character model that adds what they miss.

The patterns (email, ip, card, phone) give the base spans. The model is a bidirectional
LSTM over characters with a conditional random field over the tags O, B-kind, I-kind. It
is trained in numpy on windows around base spans of the corpus and around other digits,
and on variants made of them by rule (numbers that run into each other, other
separators), at most SAMPLE windows a kind. It is applied to overlapping windows: a span
cut by a window's end is united with the part the next window sees, and where spans of
different kinds overlap the one with the higher mean score stays. An added span has to
have its kind's form, and must not overlap a base span.

Every span of these kinds holds a digit or an @. Only the text around such characters
reaches the model; the rest is O by that definition, not by a cut.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.llm import words as W
from surveyspark.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone")
REACH = 24          # characters of context on either side of a digit or @
LENGTH, STEP = 64, 32
HIDDEN = 24
SAMPLE = 400        # most labelled windows of each kind, and of none
STEPS, BATCH, RATE = 500, 64, 0.02
BLOCK = 1024        # windows decoded together

#: The patterns, the sizes in digits, and the largest part of an address.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = {"card": (14, 19), "phone": (10, 15)}
MOST = 255

# symbols: 0 padding, 1 digit, 2 white space, 3 beyond ASCII, 4 control, printable ASCII
SYMBOLS = 5 + 95
_SYMBOL = np.full(128, 4, dtype=np.int64)
_SYMBOL[32:127] = np.arange(5, 5 + 95)
_SYMBOL[48:58] = 1
_SYMBOL[[9, 10, 11, 12, 13, 32]] = 2
TAGS = 1 + 2 * len(KINDS)  # 0: outside, 1 + 2k: begin, 2 + 2k: inside of kind k
_MAY_FOLLOW = np.zeros((TAGS, TAGS), dtype=np.float32)
for _k in range(len(KINDS)):
    _MAY_FOLLOW[[t for t in range(TAGS) if t not in (1 + 2 * _k, 2 + 2 * _k)], 2 + 2 * _k] = -1e4

Span = tuple[int, int, int]  # start, place in KINDS, end; code points, end exclusive


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(v * 2 - 9 * (v > 4) for v in map(int, digits[-2::-2]))) % 10 == 0


def has_form(kind: str, text: str) -> bool:
    """Whether a span's text can be of the kind: parts of an address, digits of a number."""
    if kind == "email":
        name, _, domain = text.partition("@")
        return bool(name.strip()) and "." in domain.strip(".")
    if kind == "ip":
        parts = text.split(".")
        return len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 10 and int(p) <= MOST for p in parts)
    digits = re.sub("[^0-9]", "", text)
    least, most = DIGITS[kind]
    return least <= len(digits) <= most and (kind == "phone" or _luhn(digits))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches from the left: each @ takes the whole run before it, so no run is tried twice."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        found = EMAIL_DOMAIN.match(text, at) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, found.end()
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Spans by the fixed patterns, by start and then kind."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for k, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        if k == 3 and "+" not in text:
            continue
        for m in pattern.finditer(text):
            if k == 1:
                good = all(len(p.lstrip("0")) <= 3 and int(p) <= MOST for p in m.group().split("."))
            else:
                good = has_form(KINDS[k], m.group())
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def doubtful(text: str) -> bool:
    """Whether a pattern matches but its check fails: such text is no example of any kind, nor of none."""
    return any(m.end() - m.start() >= DIGITS[KINDS[k]][0] and not has_form(KINDS[k], m.group())
               for k, pattern in ((2, CARD), (3, PHONE)) for m in pattern.finditer(text))


def segments(text: str) -> list[tuple[int, str]]:
    """(start, piece) of the text around digits and @, pieces not overlapping."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    hits = np.flatnonzero(((codes >= 48) & (codes <= 57)) | (codes == 64))
    if not len(hits):
        return []
    cut = np.flatnonzero(np.diff(hits) > 2 * REACH)
    first, last = hits[np.append(0, cut + 1)], hits[np.append(cut, len(hits) - 1)]
    return [(a, text[a:b]) for a, b in zip(np.maximum(first - REACH, 0).tolist(),
                                           np.minimum(last + REACH + 1, len(codes)).tolist())]


def symbols(piece: str) -> np.ndarray:
    codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(codes < 128, _SYMBOL[np.minimum(codes, 127)], 3)


def window_starts(n: int) -> list[int]:
    """Overlapping windows of LENGTH over n characters, the last one at the end."""
    if n <= LENGTH:
        return [0]
    return [*range(0, n - LENGTH, STEP), n - LENGTH]


# --- the model ---------------------------------------------------------------

def _new_parameters(seed: int = 7) -> dict[str, np.ndarray]:
    """Input and state weights of both directions, emissions, transitions."""
    rng = np.random.default_rng(seed)
    p = {"x": rng.standard_normal((2, SYMBOLS, 4 * HIDDEN)) * 0.3,
         "u": rng.standard_normal((2, HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN),
         "e": rng.standard_normal((2 * HIDDEN, TAGS)) * 0.1, "eb": np.zeros(TAGS), "a": np.zeros((TAGS, TAGS))}
    p["x"][:, :, HIDDEN:2 * HIDDEN] += 1  # forget gates start open
    return {k: v.astype(np.float32) for k, v in p.items()}


_SIDES = np.arange(2)[:, None]


def _both_ways(x: np.ndarray) -> np.ndarray:
    """(2, windows, time): the windows, and the same read from the end."""
    return np.stack([x, x[:, ::-1]])


def _lstm(p, x: np.ndarray, live: np.ndarray, keep: bool = False):
    """States (time, windows, 2 HIDDEN); with `keep`, what the backward pass needs."""
    n, length = x.shape
    x, live = _both_ways(x), _both_ways(live)
    h = c = np.zeros((2, n, HIDDEN), dtype=np.float32)
    out, saved = np.empty((length, 2, n, HIDDEN), dtype=np.float32), []
    for t in range(length):
        a = p["x"][_SIDES, x[:, :, t]] + h @ p["u"]
        gates = 1 / (1 + np.exp(-a[:, :, :3 * HIDDEN]))
        i, f, o = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:2 * HIDDEN], gates[:, :, 2 * HIDDEN:]
        g = np.tanh(a[:, :, 3 * HIDDEN:])
        m = live[:, :, t, None]
        new_c = (f * c + i * g) * m
        squashed = np.tanh(new_c)
        new_h = o * squashed * m
        if keep:
            saved.append((h, c, i, f, o, g, squashed, m))
        h, c = new_h, new_c
        out[t] = h
    return np.concatenate([out[:, 0], out[::-1, 1]], axis=2), saved


def _lstm_back(p, x: np.ndarray, saved, d_states: np.ndarray, grads) -> None:
    n, length = x.shape
    x = _both_ways(x)
    d_out = np.stack([d_states[:, :, :HIDDEN], d_states[::-1, :, HIDDEN:]], axis=1)
    dh = dc = np.zeros((2, n, HIDDEN), dtype=np.float32)
    inputs = np.empty((2, length, n, 4 * HIDDEN), dtype=np.float32)
    back = p["u"].transpose(0, 2, 1)
    for t in range(length - 1, -1, -1):
        h, c, i, f, o, g, squashed, m = saved[t]
        dh = (dh + d_out[t]) * m
        dc = (dc + dh * o * (1 - squashed * squashed)) * m
        da = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f),
                             dh * squashed * o * (1 - o), dc * i * (1 - g * g)], axis=2)
        inputs[:, t] = da
        grads["u"] += h.transpose(0, 2, 1) @ da
        dh, dc = da @ back, dc * f
    for side in range(2):
        symbol = x[side].T.ravel()
        order = np.argsort(symbol, kind="stable")
        first = np.flatnonzero(np.append(True, symbol[order][1:] != symbol[order][:-1]))
        grads["x"][side][symbol[order][first]] = np.add.reduceat(
            inputs[side].reshape(-1, 4 * HIDDEN)[order], first, axis=0)


def _emissions(p, x: np.ndarray, live: np.ndarray, keep: bool = False):
    states, saved = _lstm(p, x, live, keep)
    return states @ p["e"] + p["eb"], states, saved


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _loss(p, x, live, tags):
    """Mean negative log-likelihood of the tag sequences, and its gradients."""
    e, states, saved = _emissions(p, x, live, keep=True)
    length, n, _ = e.shape
    trans = p["a"] + _MAY_FOLLOW
    on = live.T.astype(bool)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, length):
        step = _log_sum(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        alpha[t] = np.where(on[t][:, None], step, alpha[t - 1])
    for t in range(length - 2, -1, -1):
        step = _log_sum(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        beta[t] = np.where(on[t + 1][:, None], step, 0)
    z = _log_sum(alpha[-1], 1)
    d_e = np.where(on[:, :, None], np.exp(alpha + beta - z[None, :, None]), 0).astype(np.float32)
    grads = {k: np.zeros_like(v) for k, v in p.items()}
    at, row = np.nonzero(on)
    tag = tags[row, at]
    gold = np.bincount(row, e[at, row, tag], minlength=n)
    d_e[at, row, tag] -= 1
    later = at > 0
    at, row, tag, before = at[later], row[later], tag[later], tags[row[later], at[later] - 1]
    gold += np.bincount(row, trans[before, tag], minlength=n)
    both = np.exp(alpha[at - 1, row][:, :, None] + trans + (e + beta)[at, row][:, None, :] - z[row, None, None])
    grads["a"] += both.sum(axis=0)
    np.subtract.at(grads["a"], (before, tag), 1)
    flat, d_flat = states.reshape(-1, 2 * HIDDEN), d_e.reshape(-1, TAGS)
    grads["e"], grads["eb"] = flat.T @ d_flat, d_flat.sum(axis=0)
    _lstm_back(p, x, saved, (d_flat @ p["e"].T).reshape(states.shape), grads)
    return float((z - gold).mean()), {k: v / n for k, v in grads.items()}


def _stack(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((len(windows), max(map(len, windows))), dtype=np.int64)
    for row, w in zip(x, windows):
        row[:len(w)] = w
    return x, (x > 0).astype(np.float32)


def train(labelled: list[tuple[str, list[Span]]], steps: int = STEPS) -> dict[str, np.ndarray] | None:
    """Parameters learned from (text, spans) windows; None without any span."""
    if not any(spans for _, spans in labelled):
        return None
    rnd = random.Random(3)
    labelled = labelled + variants(labelled, rnd)
    p = _new_parameters()
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(w) for k, w in p.items()}
    waiting: list = []
    for step in range(1, steps + 1):
        while len(waiting) < BATCH:
            waiting += rnd.sample(labelled, len(labelled))
        chosen, waiting = waiting[:BATCH], waiting[BATCH:]
        windows, tags = [], np.zeros((BATCH, LENGTH), dtype=np.int64)
        for row, (text, spans) in zip(tags, chosen):
            a = rnd.randrange(0, max(1, min(REACH, len(text) - LENGTH // 2)))  # windows begin anywhere
            windows.append(symbols(text[a:a + LENGTH]))
            row[:] = tag_row(spans, a, LENGTH)
        x, live = _stack(windows)
        _, grads = _loss(p, x, live, tags[:, :x.shape[1]])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = RATE * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for name, g in grads.items():
            g = g * np.float32(min(1.0, 5.0 / max(norm, 1e-9)))
            m[name] += np.float32(0.1) * (g - m[name])
            v[name] += np.float32(0.001) * (g * g - v[name])
            p[name] -= np.float32(rate) * m[name] / (np.sqrt(v[name]) + np.float32(1e-8))
    return p


def tag_row(spans: list[Span], offset: int, length: int) -> np.ndarray:
    """Tags of `length` characters from `offset` on; of overlapping spans the first stays."""
    row, taken = np.zeros(length, dtype=np.int64), offset
    for start, kind, end in sorted(spans):
        if start < taken and start >= offset or end <= max(taken, offset):
            continue
        a, b = max(start - offset, 0), min(end - offset, length)
        if a < b:
            row[a:b] = 2 + 2 * kind
            if start >= offset:
                row[a] = 1 + 2 * kind
            taken = end
    return row


def variants(labelled: list[tuple[str, list[Span]]], rnd: random.Random) -> list[tuple[str, list[Span]]]:
    """Windows made of the given ones by rule: joined numbers, other separators, and plain numbers."""
    out = []
    found = {k: [(t, s) for t, spans in labelled for s in spans if s[1] == k and s[2] <= len(t)] for k in range(4)}

    def number(n):
        return "".join(rnd.choice("0123456789") for _ in range(n))

    def put(text, span, *parts):
        """The window with the span replaced by parts, each (text, kind or None)."""
        made, spans = text[:span[0]], []
        for part, kind in parts:
            if kind is not None:
                spans.append((len(made), kind, len(made) + len(part)))
            made += part
        out.append((made + text[span[2]:], spans))

    for k, windows in found.items():
        for text, span in windows:
            own = text[span[0]:span[2]]
            other = found[rnd.choice([2, 3])] or windows
            near, s = rnd.choice(other)
            neighbour, kind = near[s[0]:s[2]], s[1]
            plan = rnd.randrange(3)
            if plan == 0 and k in (2, 3):
                put(text, span, (number(rnd.randint(1, 4)) + " ", None), (own, k))
            elif plan == 0:
                put(text, span, (own, k), (" " + number(rnd.randint(1, 6)), None))
            elif plan == 1:
                put(text, span, (own, k), (rnd.choice([" ", ", ", "; "]), None), (neighbour, kind))
            elif k == 2:
                sep = rnd.choice([" ", "-", "."])
                put(text, span, (sep.join(re.findall("[0-9]{1,4}", own)), k))
            elif k == 3:
                put(text, span, (own.replace("+", rnd.choice(["00", "00 ", ""]), 1), k))
            elif k == 0:
                put(text, span, (own.replace("@", rnd.choice([" @ ", "@ "]), 1), k))
            else:
                put(text, span, (own, k), (":" + number(rnd.randint(2, 5)), None))
            plain = rnd.choice([
                number(rnd.randint(1, 9)), f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}:{number(2)}",
                f"{number(1)}.{number(rnd.randint(1, 4))}", f"{number(2)}.{number(2)}.{number(4)}",
                "".join(rnd.choice("0123456789abcdef") for _ in range(rnd.randint(8, 40)))])
            put(text, span, (plain, None))
    return out


def decode(p, windows: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Best tags of each window and the score margin of every tag over O."""
    out = []
    for k in range(0, len(windows), BLOCK):
        x, live = _stack(windows[k:k + BLOCK])
        e = _emissions(p, x, live)[0]
        trans = p["a"] + _MAY_FOLLOW
        length, n, _ = e.shape
        back = np.zeros((length, n, TAGS), dtype=np.int8)
        best = e[0]
        for t in range(1, length):
            paths = best[:, :, None] + trans
            step = paths.max(axis=1) + e[t]
            on = live[:, t, None] > 0
            back[t] = np.where(on, paths.argmax(axis=1), np.arange(TAGS))
            best = np.where(on, step, best)
        tags = np.empty((length, n), dtype=np.int64)
        tags[-1] = best.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(n), tags[t]]
        margin = np.take_along_axis(e, tags[:, :, None], 2)[:, :, 0] - e[:, :, 0]
        for i in range(n):
            size = len(windows[k + i])
            out.append((tags[:size, i], margin[:size, i]))
    return out


def spans_of(tags: np.ndarray, margin: np.ndarray, offset: int) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, mean margin) of a window's tagged runs."""
    kind = np.where(tags > 0, (tags - 1) // 2, -1)
    begin = (tags > 0) & ((tags % 2 == 1) | np.append(True, kind[1:] != kind[:-1]))
    stop = (tags > 0) & np.append(begin[1:] | (kind[1:] < 0), True)
    return [(offset + a, int(kind[a]), offset + b + 1, float(margin[a:b + 1].mean()))
            for a, b in zip(np.flatnonzero(begin).tolist(), np.flatnonzero(stop).tolist())]


def reconcile(found: list[tuple[int, int, int, float]]) -> list[Span]:
    """Spans of all windows of a text: overlapping ones of a kind united, then the best of each overlap."""
    united: list[list] = []
    for kind in range(len(KINDS)):
        last = None
        for start, _, end, score in sorted(x for x in found if x[1] == kind):
            if last and start < last[2]:
                last[2], last[3] = max(last[2], end), max(last[3], score)
            else:
                last = [start, kind, end, score]
                united.append(last)
    united.sort(key=lambda x: x[0])
    kept: list[list] = []
    for x in united:  # by start: an overlap is with the last one kept
        if kept and x[0] < kept[-1][2]:
            if (x[3], x[2] - x[0]) > (kept[-1][3], kept[-1][2] - kept[-1][0]):
                kept[-1] = x
        else:
            kept.append(x)
    return [(a, k, b) for a, k, b, _ in kept]


def added_spans(base: list[Span], found: list[Span], piece_of) -> list[Span]:
    """Model spans, white space and stops trimmed, that have their kind's form and overlap no base span."""
    out = []
    base = sorted(base)
    starts = np.array([s[0] for s in base], dtype=np.int64)
    reach = np.maximum.accumulate(np.array([s[2] for s in base], dtype=np.int64)) if base else starts
    for a, k, b in found:
        text = piece_of(a, b)
        a += len(text) - len(text.lstrip(" .,;:-\n\t"))
        b = a + len(text.strip(" .,;:-\n\t"))
        before = int(np.searchsorted(starts, b, side="left"))
        if b > a and (before == 0 or reach[before - 1] <= a) and has_form(KINDS[k], piece_of(a, b)):
            out.append((a, k, b))
    return out


# --- on tables ---------------------------------------------------------------

_LISTS = "base array<int>, starts array<int>, pieces array<string>"


def located(docs: DataFrame) -> DataFrame:
    """doc_id, base, starts, pieces of every row: base spans as flat triples, and the text around digits and @."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def rows(batches):
        for batch in W.slices(batches):
            text = W.strings(batch.column("text"))
            raw, offsets = W.buffers(text)
            hit = np.flatnonzero(((raw >= 48) & (raw <= 57)) | (raw == 64))
            row = np.unique(np.searchsorted(offsets, hit, side="right") - 1).tolist()
            base, starts, pieces = ([[] for _ in range(batch.num_rows)] for _ in range(3))
            for i, t in zip(row, text.take(pa.array(row, pa.int64())).to_pylist()):
                base[i] = [v for span in base_spans(t) for v in span]
                found = segments(t)
                starts[i], pieces[i] = [a for a, _ in found], [s for _, s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(pieces, pa.list_(pa.string()))], ["doc_id", "base", "starts", "pieces"])

    return docs.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, {_LISTS}")


def _triples(flat: list[int]) -> list[Span]:
    return list(zip(flat[::3], flat[1::3], flat[2::3]))


def labelled_windows(where: DataFrame, sample: int = SAMPLE) -> list[tuple[str, list[Span]]]:
    """At most `sample` different windows of each kind of base span, and of none.

    They are those with the smallest hashes, so neither order nor copies matter. Windows
    with a match that its check drops are left out: they hold what the model is to find.
    """
    def rows(batches):
        for batch in batches:
            made: dict[str, list] = {"kind": [], "piece": [], "spans": []}
            for base, starts, pieces in zip(*(batch.column(c).to_pylist() for c in ("base", "starts", "pieces"))):
                spans = _triples(base)
                at = 0
                for start, piece in zip(starts, pieces):
                    while at < len(spans) and spans[at][0] < start:
                        at += 1
                    for a in range(0, max(1, len(piece) - REACH), LENGTH):
                        text = piece[a:a + LENGTH + REACH]
                        begin, stop = start + a, start + a + len(text)
                        inside, k = [], at
                        while k < len(spans) and spans[k][0] < stop:
                            if spans[k][0] >= begin:
                                inside.append((spans[k][0] - begin, spans[k][1], spans[k][2] - begin))
                            k += 1
                        if doubtful(text):
                            continue
                        made["kind"].append(inside[0][1] if inside else -1)
                        made["piece"].append(text)
                        made["spans"].append([v for s in inside for v in s])
            yield pa.RecordBatch.from_arrays(
                [pa.array(made["kind"], pa.int32()), pa.array(made["piece"], pa.string()),
                 pa.array(made["spans"], pa.list_(pa.int32()))], ["kind", "piece", "spans"])

    found = (where.filter(F.size("starts") > 0).select("base", "starts", "pieces")
             .mapInArrow(rows, "kind int, piece string, spans array<int>")
             .groupBy("kind", "piece", "spans").count())
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.xxhash64("piece"), "piece", "spans"))
    chosen = found.withColumn("place", place).filter(F.col("place") <= sample)
    return [(r.piece, _triples(r.spans)) for r in chosen.orderBy("kind", "place").collect()]


def tag_batch(p, where: list[tuple[list[Span], list[int], list[str]]]) -> list[list[Span]]:
    """Added spans of every text, given its base spans and its pieces."""
    windows, source = [], []
    for row, (_, starts, pieces) in enumerate(where):
        for start, piece in zip(starts, pieces):
            ids = symbols(piece)
            for a in window_starts(len(ids)):
                windows.append(ids[a:a + LENGTH])
                source.append((row, start + a))
    found: list[list] = [[] for _ in where]
    for k in range(0, len(windows), BLOCK):
        for (row, offset), (tags, margin) in zip(source[k:k + BLOCK], decode(p, windows[k:k + BLOCK])):
            if tags.any():
                found[row].extend(spans_of(tags, margin, offset))
    out = []
    for (base, starts, pieces), spans in zip(where, found):
        edges = np.array(starts, dtype=np.int64)

        def piece_of(a, b, edges=edges, pieces=pieces):
            k = int(np.searchsorted(edges, a, side="right")) - 1
            return pieces[k][a - int(edges[k]):b - int(edges[k])]

        out.append(added_spans(base, reconcile(spans), piece_of))
    return out


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def personal_data(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added of every row.

    Counts and digest are those of the base spans; `spans` holds them and the n_added
    ones of the model. A null text is empty; repeated rows and null ids are rows of
    their own; in a corpus without a base span the model adds nothing. An empty table
    gives no row; other columns are ignored.
    """
    spark = docs.sparkSession
    where = Scratch(spark, "personal").stage(located(docs), "where")
    learned = train(labelled_windows(where, sample), steps)
    shared = spark.sparkContext.broadcast(learned)
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]

    def rows(batches):
        p = shared.value
        for batch in W.slices(batches):
            texts = [(_triples(b), s, t) for b, s, t in
                     zip(*(batch.column(c).to_pylist() for c in ("base", "starts", "pieces")))]
            added = tag_batch(p, texts) if p is not None else [[] for _ in texts]
            base = [x[0] for x in texts]
            number = [np.bincount([s[1] for s in b], minlength=len(KINDS)).tolist() if b else [0] * len(KINDS)
                      for b in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([n[k] for n in number], pa.int64()) for k in range(len(KINDS))],
                 pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b in base]),
                 pa.array([_joined(b + a) for b, a in zip(base, added)]),
                 pa.array([len(a) for a in added], pa.int64())],
                ["doc_id", *counts, "base_sha256", "spans", "n_added"])

    return where.mapInArrow(rows, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in counts)
                            + ", base_sha256 string, spans string, n_added long")
