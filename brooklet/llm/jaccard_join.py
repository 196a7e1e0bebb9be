"""Similarity self-join of documents by the Jaccard coefficient of their word shingles.

Rare-first prefix filtering: two sets of the wanted similarity share an element within short
prefixes, if all sets are sorted alike. Frequent shingles come last in that order, so common
passages stay out of the prefixes. Equal sets are one class from the start; classes are joined on
prefix shingles, each pair at most once, and compared by their whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brooklet.llm.common import BASE_2, SMALL_BATCHES, SPACED, chunks, column, maybe_among, mixed, pairs_hash, powers, row_ranges, settings, words, written
from brooklet.llm.components import components

WORDS = 5
PERCENT = 80
#: Frequent shingles that the order knows by their count; the others count as rare. Any order gives
#: the same result, this one only sets its cost, so the bound is one of memory: 20 MB.
FREQUENT = 1_000_000
#: Shingles that a task counts at once for that order.
COUNTED = 2_000_000
#: A shingle with more pairs that are not known to be connected, as a multiple of its classes, takes a
#: round with one pivot first; after so many rounds its classes are compared in blocks, if they are many.
CROWDED = 1
PIVOT_ROUNDS = 3
#: The same multiple after the last round, up to which the pairs themselves are listed.
LISTED = 16
#: Pairs still apart, as a multiple of all rows before the first round, up to which the last round follows at once.
FEW_LEFT = 8
#: Classes of a block, and shingles of all their sets.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
#: Pairs of texts that are compared at once.
COMPARED = 64
#: Bytes of text whose shingles are made at once.
TEXT_BYTES = 1 << 20
#: Parts of the hash range (by the upper eight bits) by whose counts, up to 127 each, the suffix filter compares two sets.
PARTS = 256

_NULL_ID = (1 << 63) - 1
_TABLE = "shingle long, class long, n int, place int, rid long, key long, parts array<tinyint>"


def _shingles(offsets: np.ndarray, data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each row, ascending: rows and 64-bit hashes."""
    n = len(offsets) - 1
    _, _, rows, hashes = words(offsets, data, SPACED, fold=True)
    count = np.bincount(rows, minlength=n)
    first = np.cumsum(count) - count
    many = np.where(count >= size, count - size + 1, 0)
    at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first, many)
    found = np.full(len(at), size, np.uint64)
    for j, weight in enumerate(powers(size, BASE_2)):
        found += hashes[at + j] * weight
    row = np.repeat(np.arange(n), many)
    short = np.flatnonzero((count > 0) & (count < size))
    whole = count[short].astype(np.uint64)
    for j, weight in enumerate(powers(size, BASE_2)):
        whole += np.where(j < count[short], hashes[np.minimum(first[short] + j, max(len(hashes) - 1, 0))] * weight, np.uint64(0))
    row, found = np.concatenate([row, short]), mixed(np.concatenate([found, whole]))
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (found[1:] != found[:-1])
    return row[new], found[new]


def _count_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Shingles that several of a task's documents in a row have, with the number of these."""
    held: list[np.ndarray] = []

    def counts() -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held) if held else np.zeros(0, np.uint64), return_counts=True)
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(found[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["shingle", "n"])

    for batch in batches:
        for _, offsets, data in chunks(column(batch, "text"), TEXT_BYTES):
            held.append(_shingles(offsets, data, size)[1])
            if sum(map(len, held)) >= COUNTED:
                yield counts()
    yield counts()


class Order:
    """Rank of shingles by count; 0 for those that are not among the frequent ones."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        by = np.argsort(shingles)
        self.shingles = shingles[by]
        self.ranks = np.unique(counts[by], return_inverse=True)[1].astype(np.int64) + 1
        self.low = np.zeros(1 << 22, bool)
        self.low[(self.shingles & np.uint64((1 << 22) - 1)).astype(np.int64)] = True

    def rank(self, found: np.ndarray) -> np.ndarray:
        out = np.zeros(len(found), np.int64)
        maybe = np.flatnonzero(self.low[(found & np.uint64((1 << 22) - 1)).astype(np.int64)])
        if len(self.shingles) and len(maybe):
            at = np.searchsorted(self.shingles, found[maybe])
            at[at == len(self.shingles)] = 0
            out[maybe] = np.where(self.shingles[at] == found[maybe], self.ranks[at], 0)
        return out


def _table_rows(batches: Iterator[pa.RecordBatch], order: Order, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """One row per document, without a shingle, and the prefix of each class, once per task."""
    schema = pa.schema([("shingle", pa.int64()), ("class", pa.int64()), ("n", pa.int32()), ("place", pa.int32()), ("rid", pa.int64()), ("key", pa.int64()), ("parts", pa.list_(pa.int8()))])
    seen: set[int] = set()
    for batch in batches:
        rids, keys = column(batch, "rid"), column(batch, "key").cast(pa.int64())
        for start, offsets, data in chunks(column(batch, "text"), TEXT_BYTES):
            rows = len(offsets) - 1
            row, found = _shingles(offsets, data, size)
            bounds = row_ranges(row, rows)
            n = np.diff(bounds)
            sums = np.zeros(len(found) + 1, np.uint64)
            np.cumsum(mixed(found + BASE_2), out=sums[1:])
            cls = pairs_hash(sums[bounds[1:]] - sums[bounds[:-1]], n.astype(np.uint64)).view(np.int64)
            part = np.bincount(row * PARTS + (found >> np.uint64(56)).astype(np.int64), minlength=rows * PARTS)
            none = pa.nulls(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    none,
                    pa.array(cls, mask=n == 0),
                    pa.array(n.astype(np.int32)),
                    pa.nulls(rows, pa.int32()),
                    rids.slice(start, rows),
                    keys.slice(start, rows),
                    pa.FixedSizeListArray.from_arrays(pa.array(np.minimum(part, 127).astype(np.int8)), PARTS).cast(pa.list_(pa.int8())),
                ],
                schema=schema,
            )
            fresh = np.zeros(rows, bool)
            for i in np.flatnonzero(n):
                if int(cls[i]) not in seen:
                    seen.add(int(cls[i]))
                    fresh[i] = True
            kept = fresh[row]
            row, found = row[kept], found[kept]
            by = np.argsort(row * (1 << 21) + order.rank(found), kind="stable")
            row, found = row[by], found[by]
            n_kept = np.where(fresh, n, 0)
            place = np.arange(len(row)) - np.repeat(np.cumsum(n_kept) - n_kept, n_kept)
            prefix = place < n[row] - -(-percent * n[row] // 100) + 1
            row, found, place = row[prefix], found[prefix], place[prefix]
            m = len(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(cls[row]), pa.array(n[row].astype(np.int32)), pa.array(place.astype(np.int32)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.list_(pa.int8()))],
                schema=schema,
            )


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Shingles of each text, ascending."""
    out: list[np.ndarray] = []
    for _, offsets, data in chunks(texts, TEXT_BYTES):
        row, found = _shingles(offsets, data, size)
        out += np.split(found, row_ranges(row, len(offsets) - 1)[1:-1])
    return out


def _linked_pairs(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) whose texts ``one`` and ``two`` link."""
    for whole in batches:
        for first in range(0, len(whole), COMPARED):
            batch = whole.slice(first, COMPARED)
            one, two = (_sets(column(batch, c), size) for c in ("one", "two"))
            common = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(one, two, strict=True)], np.int64)
            union = np.array([len(x) + len(y) for x, y in zip(one, two, strict=True)], np.int64) - common
            kept = pa.array(np.flatnonzero(100 * common >= percent * union))
            yield pa.RecordBatch.from_arrays([column(batch, c).take(kept) for c in ("a", "b")], names=["a", "b"])


def _linked_in_block(rows: pa.Table, size: int, percent: int) -> pa.Table:
    """Links among the classes of a block, or between two blocks, as many as connect what links connect.

    Classes of one label, and those that a link of this block has connected, are not compared.
    """
    rows = rows.combine_chunks()
    classes, n, place = (rows[c].to_numpy() for c in ("class", "n", "place"))
    sets = _sets(rows["text"].combine_chunks(), size)
    bounds = np.cumsum([0, *map(len, sets)])
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
    group = np.unique(rows["label"].to_numpy(), return_inverse=True)[1]
    first, second = rows["first"].to_numpy(zero_copy_only=False), rows["second"].to_numpy(zero_copy_only=False)
    found: list[tuple[int, int]] = []
    inside = np.zeros(int(numbers.max(initial=-1)) + 1, bool)
    for x in np.flatnonzero(first):
        least = -(-percent * (n[x] + n) // (100 + percent))
        maybe = second & (group != group[x]) & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])) & (np.minimum(n - place, n[x] - place[x]) >= least)
        maybe = np.flatnonzero(maybe)
        if not len(maybe):
            continue
        own = numbers[bounds[x] : bounds[x + 1]]
        inside[own] = True
        sizes = bounds[maybe + 1] - bounds[maybe]
        starts = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) - np.repeat(starts - bounds[maybe], sizes)
        common = np.add.reduceat(inside[numbers[at]].astype(np.int64), starts)
        inside[own] = False
        for y in maybe[100 * common >= percent * (n[x] + n[maybe] - common)]:
            if group[y] != group[x]:
                found.append((int(classes[x]), int(classes[y])))
                group[group == group[y]] = group[x]
    return pa.table({"a": pa.array([min(p) for p in found], pa.int64()), "b": pa.array([max(p) for p in found], pa.int64())})


def _linked_in_crowds(crowded: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links that connect the classes of crowded shingles (shingle, class, n, place, label), from whole comparisons in blocks.

    Shingles with the same classes count once. A crowd that fits into a block is one unit. Of others the
    sizes are cut into levels so that linked classes are in the same or in neighbouring ones; each
    level is dealt into blocks, and each unit takes one or two of them, so a crowd of c classes
    costs c / ``BLOCK`` rows a class and no row a pair.
    """
    same = crowded.groupBy("shingle").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("class")).alias("h"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("g"))
    same = same.withColumn("crowd", F.min("shingle").over(Window.partitionBy("c", "h", "g"))).select("shingle", "crowd")
    # The smallest place of any of the shingles bounds what two classes have in common.
    rows = crowded.join(same, "shingle").groupBy("crowd", "class").agg(F.first("n").alias("n"), F.min("place").alias("place"), F.first("label").alias("label"))
    small = rows.groupBy("crowd").agg(((F.count("*") <= BLOCK) & (F.sum("n") <= BLOCK_SHINGLES)).alias("small"))
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    rows = written(rows.join(small, "crowd").withColumn("level", F.when(F.col("small"), 0).otherwise(level)), "op2-crowds")
    per = rows.groupBy("crowd", "level").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    per = per.groupBy("crowd").agg(F.map_from_entries(F.collect_list(F.struct("level", "blocks"))).alias("blocks"))  # one entry a level, some 80 at most
    rows = rows.join(per, "crowd")

    def others(level: Column) -> Column:
        last = F.coalesce(F.try_element_at("blocks", level), F.lit(0)) - 1
        return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))

    def unit(level: Column, i: Column, j: Column, beside: Column, first: Column, second: Column) -> Column:
        return F.struct(level.alias("level"), i.alias("i"), j.alias("j"), beside.alias("beside"), first.alias("first"), second.alias("second"))

    level, block, yes, no = F.col("level"), F.col("block"), F.lit(True), F.lit(False)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.element_at("blocks", level)).cast("int"))
    # Units of one level take two of its blocks, or one against itself; units of two levels a block of each.
    within = F.transform(others(level), lambda o: unit(level, F.least(block, o), F.greatest(block, o), no, block <= o, block >= o))
    above = F.transform(others(level + 1), lambda o: unit(level, block, o, yes, yes, no))
    under = F.transform(others(level - 1), lambda o: unit(level - 1, o, block, yes, no, yes))
    dealt = rows.select("crowd", "class", "n", "place", "label", F.inline(F.concat(within, above, under)))
    # A unit without both sides, or with one label only, has nothing to compare.
    whole = dealt.groupBy("crowd", "level", "beside", "i", "j").agg(F.max("first").alias("a"), F.max("second").alias("b"), F.min("label").alias("least"), F.max("label").alias("most"))
    whole = whole.where("a AND b AND least <> most").select("crowd", "level", "beside", "i", "j")
    dealt = dealt.join(whole, ["crowd", "level", "beside", "i", "j"], "left_semi")
    dealt = dealt.join(texts, "class")
    return dealt.groupBy("crowd", "level", "beside", "i", "j").applyInArrow(lambda table: _linked_in_block(table, size, percent), "a long, b long")


def _with_partners(rows: DataFrame, percent: int) -> DataFrame:
    """Rows (shingle, class, n, place) that may have a partner among those of their shingle, and c, how many of these are left.

    What stands from ``place`` on bounds what two sets have in common, so partners have ``reach`` shingles at
    most, each as the other's reach says. Of two rows the answer is exact; of more, a row goes only if no other fits.
    """
    rows = rows.withColumn("reach", F.expr(f"{100 + percent} * (cast(n AS long) - place) div {percent} - n"))
    up = Window.partitionBy("shingle").orderBy("n", "class")
    down = Window.partitionBy("shingle").orderBy(F.desc("n"), F.desc("class"))
    # Frames that grow from the first row on cost one step a row, ones that shrink to the last row would cost a pass a row.
    fits = rows.withColumns({"shorter": F.max("reach").over(up.rowsBetween(Window.unboundedPreceding, -1)), "least": F.first("n").over(up), "after": F.lead("n").over(up)})
    fits = fits.withColumn("longer", F.max("reach").over(down.rowsBetween(Window.unboundedPreceding, -1)))
    longer = (F.col("after") <= F.col("reach")) & (F.col("longer") >= F.col("n"))
    shorter = (F.col("shorter") >= F.col("n")) & (F.col("least") <= F.col("reach"))
    kept = fits.where(longer | shorter).select("shingle", "class", "n", "place")
    return kept.withColumn("c", F.count("*").over(Window.partitionBy("shingle"))).where("c > 1")


def similar_components(docs: DataFrame, key: str = "doc_id", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Groups of documents that links connect, and the size of each document's set.

    A document's set holds the distinct shingles of ``size`` words of its whole text, with A-Z as
    a-z; one of fewer words has them all as its one shingle. Two documents link if their sets'
    Jaccard coefficient is ``percent`` in a hundred or more. Gives one row per document: ``key``,
    n_shingles, component_id (smallest key that links reach, its own included), rid (hash of key
    and text) and first (whether it is the group's first row, by key and rid).

    Null texts and texts without words have an empty set and no link, so their component is their
    own key. A null key stays; its component is the smallest key that is not null, or null. Rows
    that repeat a key are documents of their own. An empty table gives an empty table; other
    columns are not read. Shingles and classes of equal sets are known by 64-bit hashes.

    Links inside a group are not all listed: classes known to be connected are not compared again.
    The classes of a shingle are all compared, unless there are many pairs among them; then one of
    them, another one in each round, is compared with the rest, and what is still apart after the
    rounds is compared in blocks that give the links that connect them, not a row for each pair. No
    pair that could link is left out.
    """
    with settings(docs.sparkSession, **SMALL_BATCHES):
        return _similar_components(docs, key, size, percent)


def _similar_components(docs: DataFrame, key: str, size: int, percent: int) -> DataFrame:
    """All but the last joins of ``similar_components`` runs here, as written tables."""
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    source = source.withColumn("rid", F.xxhash64("key", "text"))
    counted = source.select("text").mapInArrow(lambda it: _count_rows(it, size), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "shingle").limit(FREQUENT).toArrow()
    order = spark.sparkContext.broadcast(Order(top.column("shingle").to_numpy().view(np.uint64), top.column("n").to_numpy()))

    table = written(source.mapInArrow(lambda it: _table_rows(it, order.value, size, percent), _TABLE), "op2-table")
    prefixes = table.where("shingle IS NOT NULL").select("shingle", "class", "n", "place")
    documents = table.where("shingle IS NULL").select("key", "class", "n", "rid", "parts")
    same = Window.partitionBy("shingle")
    shared = prefixes.withColumns({"least": F.min("class").over(same), "most": F.max("class").over(same)}).where("least <> most")
    buckets = written(_with_partners(shared.drop("least", "most").distinct(), percent), "op2-buckets")

    joined = written(buckets.select("class").distinct(), "op2-joined")
    one = maybe_among(documents, "class", joined).groupBy("class").agg(F.min("rid").alias("rid"), F.first("n").alias("n"), F.first("parts").alias("parts"))
    one = written(one.join(joined, "class"), "op2-classes")
    parts = one.select("class", "n", "parts")

    def with_texts(texts: DataFrame | None, classes: DataFrame) -> DataFrame:
        """A text of each class: those at hand, and those of further classes. They are half as large as their sets."""
        classes = classes.distinct()
        if texts is not None:
            classes = classes.join(texts.select("class"), "class", "left_anti")
        wanted = written(one.join(classes, "class").select("rid", "class"), "op2-wanted")
        if texts is not None and wanted.isEmpty():
            return texts
        found = maybe_among(source.select("rid", "text"), "rid", wanted.select("rid"))
        found = found.join(wanted.hint("shuffle_hash"), "rid").dropDuplicates(["rid"])
        found = written(found.select("class", "text"), "op2-texts")
        return found if texts is None else texts.unionByName(found)

    live = buckets.withColumns({"label": F.col("class"), "crowded": F.col("c") - 1 > 2 * CROWDED}).drop("c")
    rows = buckets.count()
    rounds: list[DataFrame] = []
    tried = texts = member = None
    for step in range(PIVOT_ROUNDS + 1):
        last = step == PIVOT_ROUNDS
        if step:  # before the first round no two classes are known to be connected
            per = live.groupBy("shingle", "label").agg(F.count("*").alias("c")).groupBy("shingle").agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("own"), F.count("*").alias("labels"))
            per = written(per.where("labels > 1").select("shingle", "all", (F.col("all") * F.col("all") - F.col("own")).alias("apart")), "op2-open")
            left = per.agg(F.sum("apart")).first()[0]
            if left is None:
                break
            last = last or left <= 2 * FEW_LEFT * rows
            crowded = F.col("apart") > 2 * (LISTED if last else CROWDED) * F.col("all")
            live = written(live.join(per, "shingle").select("shingle", "class", "n", "place", "label", crowded.alias("crowded")), "op2-live")
        elif not rows:
            break
        least = F.ceil(F.lit(percent) * (F.col("x.n") + F.col("y.n")) / F.lit(100 + percent))  # common shingles that a link needs
        near = (F.lit(100) * F.least("x.n", "y.n") >= F.lit(percent) * F.greatest("x.n", "y.n")) & (F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) >= least)
        apart = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.label") != F.col("y.label")) & near
        few, many = live.where("NOT crowded"), live.where("crowded")
        pair = (F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"))
        pairs = few.alias("x").join(few.alias("y"), apart & (F.col("x.class") < F.col("y.class"))).select(*pair)
        if not last:
            # A class with many crowded shingles is near the middle of its group, and links with most of it.
            many = many.join(many.groupBy("class").agg(F.count("*").alias("central")), "class")
            pivots = many.groupBy("shingle").agg(F.max(F.struct("central", F.xxhash64("class", F.lit(step)).alias("h"), "class", "n", "place", "label")).alias("p"))
            pivots = written(pivots.select("shingle", "p.class", "p.n", "p.place", "p.label"), "op2-pivots")
            pairs = pairs.unionByName(many.alias("x").join(pivots.alias("y"), apart).select(*pair))
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = written(pairs, "op2-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)

        counts = maybe_among(parts, "class", pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))))
        both = pairs.join(counts.select(F.col("class").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa")), "a").join(counts.select(F.col("class").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb")), "b")
        differ = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
        total = F.col("na") + F.col("nb")
        both = written(both.where(differ <= total - 2 * F.ceil(F.lit(percent) * total / F.lit(100 + percent))).select("a", "b"), "op2-candidates")
        ends = both.select(F.col("a").alias("class")).unionByName(both.select(F.col("b").alias("class")))
        texts = with_texts(texts, ends.unionByName(live.where("crowded").select("class")) if last else ends)
        near = maybe_among(texts, "class", ends)
        both = both.join(near.select(F.col("class").alias("a"), F.col("text").alias("one")), "a").join(near.select(F.col("class").alias("b"), F.col("text").alias("two")), "b")
        rounds.append(written(both.select("a", "b", "one", "two").mapInArrow(lambda it: _linked_pairs(it, size, percent), "a long, b long"), "op2-links"))
        if last:
            rounds.append(written(_linked_in_crowds(live.where("crowded"), texts, size, percent), "op2-crowd-links"))
            break

        # Equal labels mean connected classes; the other way round holds only after the last round.
        # Two steps carry the smallest label to the pivot and from there to all that link with it.
        live = live.where("crowded").drop("crowded")
        labels = live.select("class", "label").distinct()
        ends = rounds[-1].unionByName(rounds[-1].select(F.col("b").alias("a"), F.col("a").alias("b")))
        for _ in range(2):
            seen = ends.join(labels.select(F.col("class").alias("b"), "label"), "b").groupBy(F.col("a").alias("class")).agg(F.min("label").alias("near"))
            labels = labels.join(seen, "class", "left").select("class", F.least("label", F.coalesce("near", "label")).alias("label"))
        live = live.drop("label").join(written(labels, "op2-labels"), "class")
    links = reduce(DataFrame.unionByName, rounds) if rounds else None
    if links is not None and not links.isEmpty():
        member = components(links, "op2").select(F.col("node").alias("class"), "label")

    one = F.struct(F.coalesce("key", F.lit(_NULL_ID)).alias("key"), "rid")
    least = documents.where("n > 0").groupBy("class").agg(F.min(one).alias("least"))
    if member is not None:
        labelled = least.join(member, "class", "left").withColumn("label", F.coalesce("label", "class"))
        group = labelled.groupBy("label").agg(F.min("least").alias("first"))
        least = labelled.join(group, "label").select("class", "first")
    else:
        least = least.withColumnRenamed("least", "first")
    least = written(least, "op2-least")
    component = F.when(F.col("first.key") != _NULL_ID, F.col("first.key"))
    out = documents.where("n > 0").join(least, "class").select("key", "n", component.alias("component_id"), "rid", (F.col("rid") == F.col("first.rid")).alias("first"))
    out = out.unionByName(documents.where("n = 0").select("key", "n", F.col("key").alias("component_id"), "rid", F.lit(True).alias("first")))
    return out.select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id", "rid", "first")


def one_of_each(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One document of each group, the one with the smallest key; of rows that are equal, one.

    Documents without words are in no group and all stay. Columns are those of ``docs``.
    """
    found = similar_components(docs, key).where("first").select("rid", (F.col("n_shingles") == 0).alias("bare")).distinct()
    found = written(found, "op2-first")
    # The document travels as one column, so its columns may have any names.
    rows = docs.select(F.xxhash64(F.col(key).cast("long"), F.col("text").cast("string")).alias("rid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    kept = maybe_among(rows, "rid", found).join(found.hint("shuffle_hash"), "rid")
    kept = kept.withColumn("row", F.when(F.col("bare"), F.monotonically_increasing_id()).otherwise(F.lit(0)))
    return kept.dropDuplicates(["rid", "row"]).select("document.*")


def op2_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("rid", "first")


OP2_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, row_number() OVER () AS r, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS ws
  FROM documents),
s AS (
  SELECT DISTINCT r, md5(array_to_string(ws[p:p + 4], ' ')) AS h
  FROM t, unnest(range(1, greatest(len(ws) - 3, least(len(ws), 1) + 1))) AS u(p)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (
  SELECT x.r AS a, y.r AS b, count(*) AS i FROM s AS x JOIN s AS y ON x.h = y.h AND x.r <> y.r
  GROUP BY x.r, y.r),
e AS (
  SELECT a, b FROM c JOIN n AS p ON p.r = a JOIN n AS q ON q.r = b
  WHERE 100 * i >= 80 * (p.n + q.n - i)),
reach AS (SELECT r AS a, r AS b FROM t UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT t.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM t LEFT JOIN n USING (r) JOIN reach ON reach.a = t.r JOIN t AS o ON o.r = reach.b
GROUP BY t.r, t.doc_id
"""
