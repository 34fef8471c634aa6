"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the sorted array of the K smallest 52-bit hashes among a text's distinct
shingles of WIDTH words (lower-cased, split at white space; a shorter text is one
shingle, a text without words none). The sketch of a text in parts is the merge of the
parts' sketches. Two sketches estimate resemblance, containment and, alone, the number of
distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH, K = 5, 128
_DIGITS = 13          # 52 bits in hexadecimal
BLOCK_ROWS = 32       # documents of neighbouring ids that are handled together
QUANTILES = 512


def word_hashes(text: Column) -> Column:
    """Hash of each word of a text, in order."""
    return F.transform(F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != ""),
                       lambda w: F.xxhash64(w))


def sketch(hashes: Column, width: int = WIDTH, k: int = K) -> Column:
    """Sketch from a column of word hashes."""
    n = F.size(hashes)
    runs = F.transform(
        F.sequence(F.lit(0), n - width),
        lambda i: F.shiftrightunsigned(F.xxhash64(*[hashes[i + j] for j in range(width)]), 64 - 4 * _DIGITS))
    one = F.array(F.shiftrightunsigned(F.xxhash64(hashes), 64 - 4 * _DIGITS))
    empty = F.array().cast("array<bigint>")
    every = F.when(n >= width, F.array_distinct(runs)).when(n > 0, one).otherwise(empty)
    return F.slice(F.sort_array(every), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, key: str, column: str, k: int = K) -> DataFrame:
    """One sketch for each key from the sketches of its parts.

    The k smallest values are kept within each task before the shuffle, so a key of many
    parts moves k values a task. A null key is a key; null sketches count as empty.
    """
    window = Window.partitionBy(key).orderBy("__value")
    values = parts.select(key, F.explode(column).alias("__value")).distinct()
    least = values.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= k)
    found = least.groupBy(F.col(key).alias("__key")).agg(F.sort_array(F.collect_list("__value")).alias("__merged"))
    return (parts.select(key).distinct().join(found, F.col(key).eqNullSafe(F.col("__key")), "left")
            .select(key, F.coalesce("__merged", F.array().cast("array<bigint>")).alias(column)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A & B| / |A | B|: the share of the union's sketch that both have; 1 for two empty sets."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    largest = F.element_at(a, -1).cast("double") + 1.0
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) * F.lit(2.0 ** 52) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A & B| / |A|; 1 for an empty A."""
    j, na, nb = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), j * (na + nb) / (1 + j) / na))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda v: F.lpad(F.lower(F.hex(v)), _DIGITS, "0")), "")


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, text, tie, block: blocks of neighbouring ids, numbered in the order of ids.

    Quantiles of doc_id make super blocks (a block's high 32 bits) of about as many rows,
    equal ranges of ids within them blocks of about BLOCK_ROWS. Null ids come first, by a
    hash of the text.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    cuts = F.percentile_approx("doc_id", [i / QUANTILES for i in range(QUANTILES + 1)], 100_000)
    row = docs.agg(F.count("doc_id").alias("n"), cuts.alias("cuts"), F.min("doc_id").alias("lo"),
                   F.max("doc_id").alias("hi")).first()
    tied = docs.withColumn("tie", F.xxhash64("text"))
    of_null = F.shiftright("tie", 56) - 1000
    sub_null = F.pmod(F.shiftright("tie", 40), F.lit(1 << 16))
    if not row.n:
        return tied.withColumn("block", of_null * F.lit(1 << 32) + sub_null)
    edges = sorted({row.lo, *row.cuts})
    each = max(1, row.n // len(edges) // BLOCK_ROWS)
    widths = [max(1, -(-(b - a) // each)) for a, b in zip(edges, [*edges[1:], row.hi + 1])]
    low, width = F.array(*map(F.lit, edges)), F.array(*map(F.lit, widths))
    at = F.size(F.filter(low, lambda x: x <= F.col("doc_id")))
    sub = F.floor((F.col("doc_id") - F.element_at(low, at)) / F.element_at(width, at))
    return tied.withColumn("block", F.when(F.col("doc_id").isNull(), of_null * F.lit(1 << 32) + sub_null)
                           .otherwise(at.cast("long") * F.lit(1 << 32) + sub))


def _block_ends(placed: DataFrame) -> DataFrame:
    """block, after: the text that follows each block's last document."""
    own = Window.partitionBy("block").orderBy("doc_id", "tie")
    # a rank would filter before the shuffle, which then could not serve the main path too
    heads = (placed.withColumn("before", F.lag("tie").over(own)).filter("before is null")
             .select(F.shiftright("block", 32).alias("super"), "block", "text"))
    firsts = heads.groupBy("super").agg(F.min("block").alias("first"))  # a row for each quantile
    ring = firsts.select("super", F.coalesce(
        F.lead("first").over(Window.orderBy("super")),
        F.first("first").over(Window.orderBy("super"))).alias("beyond"))
    chain = heads.select("super", "block", F.lead("block").over(
        Window.partitionBy("super").orderBy("block")).alias("following"))
    chain = chain.join(F.broadcast(ring), "super").select(
        "block", F.coalesce("following", "beyond").alias("following"))
    return chain.join(heads.select(F.col("block").alias("following"), F.col("text").alias("after")),
                      "following").select("block", "after")


def fingerprint_documents(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and likenesses.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The edited text has its last floor(n_chars / 2) code points replaced by as
    many first ones (or all) of the next document by doc_id, the last document's next
    being the first. A null text is empty. Rows with a null doc_id come before all
    others, rows of one doc_id follow each other in the order of a hash of the text. Each
    text moves through one shuffle.
    """
    placed = _placed(docs)
    own = Window.partitionBy("block").orderBy("doc_id", "tie")
    paired = placed.withColumn("next_text", F.lead("text").over(own))
    ends = _block_ends(placed)
    joined = paired.join(ends, "block").withColumn("next_text", F.coalesce("next_text", "after"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    texts = (joined.withColumn("n_chars", F.char_length("text").cast("long"))
             .withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                            F.substring("next_text", F.lit(1), half))))
    last = F.lead("tie").over(own).isNull()
    hashed = texts.select(
        "doc_id", "tie", "block", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        word_hashes(F.col("text")).alias("own_words"), word_hashes(F.col("edited")).alias("edited_words"),
        word_hashes(F.when(last, F.col("after"))).alias("after_words"))
    sketched = hashed.select(
        "doc_id", "tie", "block", "n_chars", "edited_sha256", sketch(F.col("own_words"), k=k).alias("a"),
        sketch(F.col("edited_words"), k=k).alias("b"), F.col("after_words"))
    sketched = sketched.withColumn("c", F.coalesce(
        F.lead("a").over(own), sketch(F.col("after_words"), k=k)))
    return sketched.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"),
        as_text(F.col("b")).alias("edited_fingerprint"), resemblance(F.col("a"), F.col("b"), k).alias("near_edited"),
        resemblance(F.col("a"), F.col("c"), k).alias("near_next"))
