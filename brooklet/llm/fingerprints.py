"""Document fingerprints from closed syncmers of words, all in expressions of Spark.

A k-mer of words is an anchor if the smallest hash of its inner s-mers stands at its first or last
place. That depends on the k-mer alone, so an anchor stays one wherever its words go.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil, isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Words of a k-mer and of an inner s-mer (two words, by which the hashes below are made).
K, S = 6, 2
#: Words by which matched anchors may differ from the usual shift between two texts.
SHIFT = 16
#: Documents in one part of the order by id, and the most parts.
PART_ROWS, PARTS = 500, 20_000

_LAST = 9223372036854775807


def with_anchors(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: all anchors (h, p) of a text column, ascending; p counts words.

    A text of fewer than ``K`` words has one anchor of all its words; one without words has none.
    """
    kept = df.columns
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    n = F.size("_h")
    df = df.withColumn("_s", F.when(n >= K, F.zip_with(F.slice("_h", F.lit(1), n - 1), F.slice("_h", F.lit(2), n - 1), lambda a, b: F.xxhash64(a, b))))
    inner = K - S + 1

    def anchor(first: Column, i: Column) -> Column:
        others = [F.get("_s", i + j) for j in range(1, inner)]
        edge = F.least(first, others[-1]) == F.least(first, *others)
        return F.when((i <= F.size("_s") - inner) & edge, F.struct(F.xxhash64(first, others[1], others[-1]).alias("h"), i.alias("p")))

    found = F.filter(F.transform("_s", anchor), lambda x: x.isNotNull())
    df = df.withColumn("_a", F.sort_array(found))
    whole = F.array(F.struct(F.xxhash64("_h").alias("h"), F.lit(0).alias("p")))
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    anchors = F.when(n >= K, F.col("_a")).when(n > 0, whole).otherwise(none)
    return df.select(*kept, anchors.alias(out))


def fingerprint(anchors: Column) -> Column:
    """Anchors as text: low 32 bits of the hash and the place."""
    return F.array_join(F.transform(anchors, lambda x: F.concat(F.hex(x["h"].bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(":"), x["p"].cast("string"))), ",")


def _bound(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made`` of a value that is computed once."""
    return F.transform(F.array(value), made)[0]


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the share, among the different anchors of both, of those that both have at the same shift.

    An anchor counts at its first place. The shift is the median difference of the places of shared
    anchors. Two fingerprints without anchors are alike (1); one without is not like another one (0).
    """
    ha, hb = F.transform(a, lambda x: x["h"]), F.transform(b, lambda x: x["h"])

    def sided(anchors: Column, side: int) -> Column:
        return F.transform(anchors, lambda x: F.struct(x["h"].alias("h"), F.lit(side).alias("side"), x["p"].alias("p")))

    def first(s: Column) -> Column:
        return F.filter(s, lambda x, i: (i == 0) | (F.get(s, i - 1)["h"] != x["h"]) | (F.get(s, i - 1)["side"] != x["side"]))

    def shifts(s: Column) -> Column:  # equal anchors of the two now stand next to each other
        found = F.transform(s, lambda x, i: F.when(F.get(s, i - 1)["h"] == x["h"], F.get(s, i - 1)["p"] - x["p"]))
        return F.struct(F.size(s).alias("n"), F.sort_array(F.filter(found, lambda d: d.isNotNull())).alias("d"))

    def share(s: Column) -> Column:
        middle = F.get(s["d"], F.floor(F.size(s["d"]) / 2).cast("int"))
        return F.size(F.filter(s["d"], lambda d: F.abs(d - middle) <= SHIFT)) / (s["n"] - F.size(s["d"]))

    out = _bound(_bound(_bound(F.sort_array(F.concat(sided(a, 0), sided(b, 1))), first), shifts), share)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(F.arrays_overlap(ha, hb), out).otherwise(F.lit(0.0))


def with_next(docs: DataFrame, key: str, carried: list[str], made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds ``next_`` columns: those of the next row by ``key``, after the last row of the first one.

    ``made`` adds columns row by row once the rows are dealt out, so that only what it reads is shuffled.

    Rows are dealt out by ranges of the key; the first row of a range goes to the range before as
    well, as the end of it. Bounds of ranges are keys of rows, at most ``PARTS`` of them. Null keys
    come last; rows with equal keys are ordered by a hash of the text and the text.
    """
    place = F.coalesce(F.col(key), F.lit(_LAST))
    stats = docs.agg(F.count("*").alias("n"), F.min(place).alias("least"))
    size = stats.first()
    parts = max(1, min(PARTS, ceil(size["n"] / PART_ROWS)))
    bounds = [size["least"] if size["n"] else 0]
    if parts > 1:
        shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
        bounds = sorted({*bounds, *docs.agg(F.percentile_approx(place, shares, F.lit(max(10_000, 4 * parts))).alias("b")).first()["b"]})
    wide = isqrt(len(bounds) - 1) + 1
    rows = [bounds[i : i + wide] for i in range(0, len(bounds), wide)]
    docs = docs.withColumn("_place", place)
    heads = F.array(*[F.lit(r[0]) for r in rows])
    docs = docs.withColumn("_row", F.greatest(F.lit(0), F.size(F.filter(heads, lambda x: x <= F.col("_place"))) - 1))
    table = F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])
    docs = docs.withColumn("_in", F.size(F.filter(F.get(table, F.col("_row")), lambda x: x <= F.col("_place"))) - 1)
    docs = docs.withColumn("_part", F.col("_row") * wide + F.greatest(F.col("_in"), F.lit(0)))
    first = F.get(F.get(table, F.col("_row")), F.greatest(F.col("_in"), F.lit(0))) == F.col("_place")
    before = F.when(F.col("_part") == 0, F.lit(len(bounds) - 1)).otherwise(F.col("_part") - 1)
    here = F.struct(F.col("_part").alias("part"), F.lit(False).alias("extra"))
    there = F.struct(before.alias("part"), F.lit(True).alias("extra"))
    docs = docs.withColumn("_at", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))))
    docs = docs.withColumns({"_to": F.col("_at.part"), "_extra": F.col("_at.extra")}).drop("_row", "_in", "_part", "_at")
    docs = made(docs.repartition("_to")).withColumn("_tie", F.xxhash64("text"))
    ordered = Window.partitionBy("_to").orderBy("_extra", "_place", "_tie", "text")
    docs = docs.withColumns({f"next_{c}": F.lead(c).over(ordered) for c in carried})
    return docs.where("NOT _extra").drop("_place", "_to", "_extra", "_tie")


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and how alike neighbours are.

    The edited text has the first code points of the next document by doc_id (after the last one:
    of the first) in place of its own last floor(n/2). Gives doc_id, n_chars, edited, anchors,
    edited_anchors and next_anchors, a row per document.

    Null texts count as empty: no anchors, fingerprint "". Null ids come last; rows with the same
    id follow each other in a fixed order; equal texts have equal fingerprints. One document is its
    own next. An empty table gives an empty table; other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    pairs = with_next(source, "doc_id", ["text", "anchors"], lambda df: with_anchors(df, "text", "anchors"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    pairs = pairs.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.left("text", n - half), F.left("next_text", half)))
    pairs = pairs.select("doc_id", "n_chars", "edited", "anchors", "next_anchors")
    return with_anchors(pairs, "edited", "edited_anchors")


def op3_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    both = compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
