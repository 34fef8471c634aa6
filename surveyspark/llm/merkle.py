"""A content-addressed manifest of documents: one hash tree per language, one over all languages.

A leaf is the digest of a row's five fields. Within a language leaves stand by doc_id
(null first, then by digest); runs of up to FANOUT nodes become the digest of their
digests until one is left, the subroot; the subroots become the root in the same way.

The store is a table of records, digest -> digests of the children, one table for each
level. Requests go down from the root: a record's children take their digits of the
rank, and what each of them leaves unselected is put at the end of its path. Requests
for leaves that share a run travel as one row until their record is found, so a level
is one join by digest on as many rows as it has nodes, and no record is met by all
leaves. The path is reversed at the end: it then leads from the leaf to the root.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.llm.scratch import Scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGIT_BITS = 3
FANOUT = 1 << DIGIT_BITS
SIZE = 32  # bytes of a digest

#: The letters that tampering lower-cases.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def digest(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def leaf_of(**replaced: Column) -> Column:
    """Digest of a row: every field as byte count, colon and value, or `-` for a null."""
    parts = []
    for name in FIELDS:
        raw = replaced.get(name, F.col(name)).cast("string").cast("binary")
        sized = F.concat(F.octet_length(raw).cast("string").cast("binary"), F.lit(bytearray(b":")), raw)
        parts.append(F.coalesce(sized, F.lit(bytearray(b"-"))))
    return digest(F.concat(*parts))


def tampered() -> Column:
    """Whether 3 divides the crc32 of the doc_id in decimal; false for a null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def numbered(rows: DataFrame, order: list[str], scratch: Scratch, name: str) -> DataFrame:
    """Rows of a written table with their `rank` (from 0) in group `g` by `order`, and its size `n`.

    Rows are sorted over all tasks by range, so a group of any size is spread out; ranks
    follow from counts per task and group.
    """
    place = "_at"  # keeps equal rows apart, so that a range can end between them
    sorted_rows = (rows.withColumn(place, F.monotonically_increasing_id())
                   .repartitionByRange("g", *order, place).sortWithinPartitions("g", *order, place)
                   .withColumn(place, F.monotonically_increasing_id()))
    kept = scratch.stage(sorted_rows.withColumn("_part", F.shiftright(place, 33)), name)
    runs = kept.groupBy("g", "_part").agg(F.min(place).alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy("g")
    before = F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = runs.select("g", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                         F.sum("_n").over(group).alias("n"))
    return (kept.join(shifts, ["g", "_part"]).withColumn("rank", F.col(place) + F.col("_shift"))
            .drop(place, "_part", "_shift"))


def grow(nodes: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """Tops (g, node, depth) of the trees over `nodes` (g, rank, n, node), and their levels.

    A level, from the leaves' parents up, holds g, rank, n, node, children.
    """
    largest = nodes.agg(F.max("n")).first()[0] or 0
    level, levels = nodes.select("g", "rank", "n", "node"), []
    tops = [level.filter("n = 1").select("g", "node", F.lit(0).alias("depth"))]
    while largest > 1:
        run = F.array_sort(F.collect_list(F.struct("rank", "node")))  # FANOUT nodes at most
        parents = (level.filter("n > 1")
                   .groupBy("g", F.shiftright("rank", DIGIT_BITS).alias("run"))
                   .agg(F.shiftright(F.max("n") + (FANOUT - 1), DIGIT_BITS).alias("n"), run.alias("nodes")))
        children = F.unhex(F.array_join(F.transform("nodes", lambda x: F.hex(x["node"])), ""))
        parents = parents.select("g", F.col("run").alias("rank"), "n", children.alias("children"))
        level = scratch.stage(parents.withColumn("node", digest(hex_text(F.col("children")))),
                              f"{name}-{len(levels) + 1}")
        levels.append(level)
        tops.append(level.filter("n = 1").select("g", "node", F.lit(len(levels)).alias("depth")))
        largest = (largest + FANOUT - 1) >> DIGIT_BITS
    return reduce(DataFrame.unionByName, tops), levels


def _segment(digit: Column) -> Column:
    """What a digit leaves unselected of `children`, on either side."""
    return F.struct(
        F.substring("children", F.lit(1), digit * SIZE).alias("left"),
        F.substring("children", (digit + 1) * SIZE + 1, F.lit(FANOUT * SIZE)).alias("right"))


def no_path() -> Column:
    return F.array().cast("array<struct<left: binary, right: binary>>")


def descend(tops: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """The lowest records on the way from `tops` (g, node, depth, path, ...) to the leaves.

    One row for each run of leaves: its number, its path so far and its children; a
    tree of one node has run 0 without children.
    """
    carried = [c for c in tops.columns if c not in ("g", "node", "depth", "path")]
    columns = ["g", "rank", "node", "path", *carried]
    start = tops.withColumn("rank", F.lit(0).cast("long"))
    front = start.filter(F.col("depth") == len(levels)).select(*columns)
    for depth in range(len(levels), 0, -1):
        store = levels[depth - 1].select("node", "children").dropDuplicates(["node"])
        front = front.join(store, "node")
        if depth > 1:
            last = (F.octet_length("children") / SIZE - 1).cast("int")
            digits = front.withColumn("digit", F.explode(F.sequence(F.lit(0), last)))
            front = digits.select(
                "g", (F.col("rank") * FANOUT + F.col("digit")).alias("rank"),
                F.substring("children", F.col("digit") * SIZE + 1, F.lit(SIZE)).alias("node"),
                F.concat("path", F.array(_segment(F.col("digit")))).alias("path"), *carried)
            front = front.unionByName(start.filter(F.col("depth") == depth - 1).select(*columns))
    runs = ["g", F.col("rank").alias("run"), "path", *carried]
    alone = start.filter("depth = 0").select(*runs, F.lit(None).cast("binary").alias("children"))
    return alone if not levels else front.select(*runs, "children").unionByName(alone)


def answer(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """Requests (g, rank, ...) with their `path`, from the leaf to the root."""
    digit = F.col("rank").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    path = F.when(F.col("children").isNull(), F.col("path")).otherwise(
        F.concat("path", F.array(_segment(digit))))
    asked = requests.withColumn("run", F.shiftright("rank", DIGIT_BITS))
    return (asked.join(runs, ["g", "run"]).withColumn("path", F.reverse(path)).drop("run", "children"))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, changed, subroot, root, path of every row, digests as binary.

    `changed` is the leaf of the tampered row, null where nothing was done to it; `path`
    holds the digests left and right of the node on every level, from the leaf to the
    root. Rows that repeat a doc_id are leaves of their own; null fields have a digest, a
    null doc_id comes first, a null language is a language of its own. An empty table
    gives no row; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    # a language's tree is named by its text after "=", the null language's by nothing
    name = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    lower = leaf_of(text=F.translate("text", UPPER, LOWER))
    leaves = scratch.stage(docs.select(
        "doc_id", name.alias("g"), leaf_of().alias("node"), F.when(tampered(), lower).alias("changed")), "leaves")
    ranked = numbered(leaves, ["doc_id", "node"], scratch, "ranked")
    subroots, levels = grow(ranked, scratch, "level")
    subroots = scratch.stage(subroots, "subroots")

    one = F.lit("all")
    trees = numbered(subroots.select(one.alias("g"), F.col("g").alias("lang"), F.col("node"), "depth"),
                     ["lang"], scratch, "languages")
    top, upper = grow(trees, scratch, "upper")
    start = top.withColumns({"path": no_path(), "root": F.col("node")})
    found = answer(trees.select("g", "rank", "lang", F.col("node").alias("subroot"), "depth"),
                   descend(start, upper))
    # going on downwards: the languages' paths from the root to the subroot
    starts = scratch.stage(found.select(
        F.col("lang").alias("g"), F.col("subroot").alias("node"), "depth",
        F.reverse("path").alias("path"), "subroot", "root"), "starts")
    runs = descend(starts, levels)
    return answer(ranked.select("g", "rank", "doc_id", "node", "changed"), runs).select(
        "doc_id", F.col("node").alias("leaf"), "changed", "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(hex_text(F.concat(step["left"], node, step["right"]))))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """The manifest's digests in hex, the proof's digest, and the root folded from the tampered rows."""
    siblings = F.array_join(F.transform("path", lambda s: hex_text(F.concat(s["left"], s["right"]))), "")
    again = folded(F.coalesce("changed", "leaf"), F.col("path"))
    out = manifest(docs).withColumns({"proof": F.sha2(siblings, 256), "again": again})
    return out.select(
        "doc_id", *[hex_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        F.col("proof").alias("proof_sha256"), hex_text(F.col("again")).alias("folded_root"),
        (F.col("again") == F.col("root")).alias("verified"))
