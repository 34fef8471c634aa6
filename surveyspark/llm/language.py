"""Language identification by hierarchical discrimination.

A linear classifier first predicts the language family; inside a family, one-versus-one
linear support vector machines vote on the language. Features are hashed counts of byte
trigrams (A-Z lower-cased) and of words over the whole text, square-rooted and scaled to
unit length. The machines are fitted on a bounded sample of labelled documents.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyspark.llm import words as W

TRIGRAMS, WORDS = 4096, 4096   # hashed features of each kind
STRETCH = 1 << 18              # bytes counted at once
TRAIN_DOCS = 1600              # most labelled documents that a model is fitted on
LETTER = regex.compile(r"\p{L}")
MARGIN_SCALE = 4.0             # from SVM margins to scores

#: Families of written languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "uralic": ("fi", "et", "hu"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "cy", "br", "gd"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "ur", "bn", "mr", "ne", "pa", "gu"),
    "semitic": ("ar", "he", "am", "mt"),
}


def family_of(lang: str) -> str:
    """The family of a language; a code without one is a family of its own."""
    code = lang.lower().split("-")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes), lang)


def features(column: pa.Array) -> np.ndarray:
    """One unit row of hashed counts for each text."""
    column = W.strings(column)
    raw, rows = W.buffers(column)
    n = len(rows) - 1
    size = TRIGRAMS + WORDS
    counts = np.zeros(n * size, dtype=np.float32)
    for a in range(0, len(raw), STRETCH):
        part = W.LOWER[raw[a:a + STRETCH + 2]].astype(np.uint32)
        if len(part) < 3:
            continue
        gram = (part[:-2] << 16 | part[1:-1] << 8 | part[2:]) * np.uint32(2654435761) >> np.uint32(20)
        at = np.arange(a, a + len(gram))
        row = np.searchsorted(rows, at, side="right") - 1
        ok = at + 2 < rows[row + 1]
        counts += np.bincount(row[ok] * size + gram[ok], minlength=len(counts)).astype(np.float32)
    hashes, offsets = W.words(column)
    row = np.repeat(np.arange(n), np.diff(offsets))
    place = row * size + TRIGRAMS + (hashes & np.uint64(WORDS - 1)).astype(np.int64)
    counts += np.bincount(place, minlength=len(counts)).astype(np.float32)
    x = np.sqrt(counts.reshape(n, size))
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.maximum(norm, 1e-9)[:, None]


def fit_svm(x: np.ndarray, y: np.ndarray, epochs: int = 12, reg: float = 1e-4) -> np.ndarray:
    """Weights (the last one is the bias) of a linear SVM by averaged subgradient steps; y is +-1."""
    rng, n = np.random.default_rng(5), len(x)
    w, mean, step = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1), 0
    weight = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    for _ in range(epochs):
        for i in rng.permutation(n):
            step += 1
            rate = 1 / (reg * (step + 1 / reg))
            margin = y[i] * (x[i] @ w[:-1] + w[-1])
            w[:-1] *= 1 - rate * reg
            if margin < 1:
                w[:-1] += rate * y[i] * weight[i] * x[i]
                w[-1] += rate * y[i] * weight[i] * 0.1
            mean += (w - mean) / step
    return mean


class Model:
    """Family machines (one against the rest) and language machines (one against one)."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        y = np.array(langs)
        families = np.array([family_of(v) for v in langs])
        self.families = sorted(set(families))
        self.members = {f: [v for v in self.langs if family_of(v) == f] for f in self.families}
        self.rows: list[np.ndarray] = []
        if len(self.families) > 1:
            self.rows += [fit_svm(x, np.where(families == f, 1.0, -1.0)) for f in self.families]
        self.pairs = []
        for f in self.families:
            for a, b in combinations(self.members[f], 2):
                own = (y == a) | (y == b)
                self.pairs.append((f, a, b))
                self.rows.append(fit_svm(x[own], np.where(y[own] == a, 1.0, -1.0)))
        self.weights = np.stack(self.rows).astype(np.float32) if self.rows else None

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        n = len(x)
        margins = (x @ self.weights[:, :-1].T + self.weights[:, -1]) if self.rows else np.zeros((n, 0))
        k = len(self.families) if len(self.families) > 1 else 0
        odds = 1 / (1 + np.exp(-MARGIN_SCALE * margins.astype(np.float64)))
        if k:
            family = margins[:, :k].argmax(axis=1)
            sure = odds[np.arange(n), family]
        else:
            family, sure = np.zeros(n, dtype=np.int64), np.ones(n)
        lang, score = np.empty(n, dtype=object), np.zeros(n)
        for f, name in enumerate(self.families):
            own = np.flatnonzero(family == f)
            members = self.members[name]
            votes = np.zeros((len(own), len(members)))
            for p, (g, a, b) in enumerate(self.pairs):
                if g == name:
                    votes[:, members.index(a)] += odds[own, k + p]
                    votes[:, members.index(b)] += 1 - odds[own, k + p]
            best = votes.argmax(axis=1)
            share = votes.max(axis=1) / max(len(members) - 1, 1) if len(members) > 1 else np.ones(len(own))
            lang[own] = np.array(members, dtype=object)[best]
            score[own] = sure[own] * share
        return lang.tolist(), score


def held_out() -> F.Column:
    """Whether crc32 of the doc_id as text leaves 2 when divided by 4; false for a null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Model | None:
    """A model from at most about `train_docs` labelled documents that are not held out.

    The sample takes as many documents of each language, those with the smallest hashes of
    doc_id, and at least one; it is bounded, and only it comes to the driver, as feature
    rows. None without labels.
    """
    known = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull()
                        & F.col("text").rlike("\\p{L}"))
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    quota = max(1, train_docs // len(counts))
    wide = quota + 8 * math.sqrt(quota) + 40  # rows expected under a limit, so that its quota is always there
    limits = docs.sparkSession.createDataFrame(
        [(lang, int(wide / n * 2.0 ** 63) if wide < n else 2 ** 63 - 1) for lang, n in sorted(counts.items())],
        "lang string, __limit long")
    chance = F.xxhash64("doc_id").bitwiseAND(F.lit(2 ** 63 - 1))
    first = Window.partitionBy("lang").orderBy("__chance", F.xxhash64("text"))
    few = (known.select("doc_id", "lang", "text", chance.alias("__chance"))
           .join(F.broadcast(limits), "lang").filter("__chance <= __limit")
           .withColumn("__place", F.row_number().over(first)).filter(F.col("__place") <= quota))

    def rows(batches):
        for batch in W.slices(batches, 256):
            x = features(batch.column("text")).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"),
                 pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "lang", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    sample = (few.select("doc_id", "lang", "text")
              .mapInArrow(rows, f"doc_id {kind}, lang string, x binary").toArrow().sort_by("doc_id"))
    if not sample.num_rows:
        return None
    x = np.stack([np.frombuffer(v.as_buffer(), np.float16) for v in sample["x"]]).astype(np.float32)
    return Model(x, sample["lang"].to_pylist())


def identify(docs: DataFrame, model: Model | None, lang_name: str = "lang_pred",
             score_name: str = "score") -> DataFrame:
    """`docs` with the predicted language and its score, in place of columns so named.

    A text that is null or has no letter gets `und` and 0, and so does every text where
    there is no model. All columns and rows are kept.
    """
    names = [c for c in docs.columns if c not in (lang_name, score_name)]
    docs = docs.select(*names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches):
        for batch in W.slices(batches, 256):
            text = batch.column("text")
            ok = np.array([bool(v and LETTER.search(v)) for v in text.to_pylist()], dtype=bool)
            lang, score = ["und"] * len(text), np.zeros(len(text))
            if shared.value is not None and ok.any():
                found, score[ok] = shared.value.predict(features(text.filter(pa.array(ok))))
                for i, v in zip(np.flatnonzero(ok), found):
                    lang[i] = v
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang), pa.array(score)], [*names, lang_name, score_name])

    schema = T.StructType([*docs.schema.fields, T.StructField(lang_name, T.StringType()),
                           T.StructField(score_name, T.DoubleType())])
    return docs.mapInArrow(rows, schema)


def identify_language(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from the others' lang."""
    model = fit(docs.select("doc_id", "text", "lang"), train_docs)
    named = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(named, model).drop("text")


def known_languages(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """`docs` without texts of no language; lang becomes the predicted one."""
    model = fit(docs.select("doc_id", "text", "lang"), train_docs)
    found = identify(docs, model, "__lang", "__score").filter("__lang <> 'und'")
    return found.withColumn("lang", F.col("__lang")).select(*docs.columns)
