"""Near-duplicate vectors by cosine: cross-polytope hashing after fast Hadamard rotations, with several probes a table.

A hash turns a vector by three rounds of random signs and a Walsh-Hadamard transform and takes the
nearest vertex of the cross-polytope: the largest coordinate and its sign. A table's bucket joins so
many hashes that vectors far apart rarely meet; a vector also probes the buckets that its
next nearest vertices give. The number of tables follows from how often pairs just at the threshold
meet, measured on made pairs when the tables are laid out.

Vectors of a crowded bucket are gathered into cells around the bucket's pivot, so that a large group
costs a row for each member and not for each pair: what the triangle inequality says of angles
between centres, radii and members settles most pairs at once, and only the rest is compared, in
blocks of bounded size. Every pair is counted by an exact comparison or by such a bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, FloatType

from brooklet.llm.common import column, mixed, written
from brooklet.llm.components import components

COSINE = 0.9
#: Share of the pairs just at the threshold that the tables must bring together.
RECALL = 0.995
#: Buckets that a vector probes in each table besides its own.
PROBES = 3
MOST_TABLES = 256
#: Made pairs on which the recall of a layout is measured.
TRIALS = 4000
#: A bucket with more vectors than this gathers them into cells; so often at most.
CROWDED = 16
ROUNDS = 4
#: Vectors of a block, and vectors that are compared with a block at once.
BLOCK, PROBED = 2048, 16384
#: Angles are compared with this margin; what falls in between is compared exactly.
MARGIN = 1e-6
#: Sign bits of a vector that thin candidates out; pairs at the threshold differ in more with a chance below 1e-6.
SKETCH_DEVIATIONS = 5

_LEAST_DIMENSION = 16
_EDGE = "cls long, links long, a long, b long"


def _turned(rows: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows under a random rotation: signs and a fast Walsh-Hadamard transform, three times."""
    n, width = rows.shape
    for sign in signs:
        rows = rows * sign
        step = 1
        while step < width:
            pairs = rows.reshape(n, -1, 2, step)
            rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, width)
            step *= 2
        rows = rows / math.sqrt(width)
    return rows


def _table_codes(rows: np.ndarray, signs: np.ndarray, last: int) -> np.ndarray:
    """The bucket of each row in one table, and the buckets it probes, as columns.

    ``signs`` has a rotation per hash; the last hash looks at the first ``last`` coordinates only.
    A probe replaces one hash's vertex by a next nearest one, where that costs least.
    """
    n, width = rows.shape
    own, others, costs, weight = np.zeros(n, np.int64), [], [], 1
    for k, sign in enumerate(signs):
        seen = width if k < len(signs) - 1 else last
        turned = _turned(rows, sign)[:, :seen]
        size = np.abs(turned)
        ranks = min(seen, PROBES + 1)
        order = np.argpartition(-size, ranks - 1, axis=1)[:, :ranks]
        order = np.take_along_axis(order, np.argsort(-np.take_along_axis(size, order, 1), axis=1, kind="stable"), 1)
        size = np.take_along_axis(size, order, 1)
        vertex = order * 2 + (np.take_along_axis(turned, order, 1) < 0)
        own += vertex[:, 0] * weight
        for j in range(1, ranks):
            others.append((vertex[:, j] - vertex[:, 0]) * weight)
            costs.append((size[:, 0] - size[:, j]) ** 2)
        weight *= 2 * seen
    if not others:
        return own[:, None]
    cheapest = np.argsort(np.stack(costs, 1), axis=1, kind="stable")[:, :PROBES]
    return np.concatenate([own[:, None], own[:, None] + np.take_along_axis(np.stack(others, 1), cheapest, 1)], axis=1)


class Layout:
    """Rotations of all tables, for so many vectors of a dimension, and hyperplanes of the sketches."""

    def __init__(self, count: int, dimension: int):
        self.width = max(_LEAST_DIMENSION, 1 << (dimension - 1).bit_length())
        hashes, last = 1, 1
        # So many buckets that two vectors far apart meet in one of a table's with a chance of one in ``count``.
        while (2 * self.width) ** (hashes - 1) * 2 * last < count * (1 + PROBES) ** 2:
            hashes, last = (hashes, last * 2) if last < self.width else (hashes + 1, 2)
        self.last = last
        random = np.random.default_rng([20240607, dimension, hashes, last])
        self.planes = random.normal(size=(dimension, 64))
        one, other = random.normal(size=(2, TRIALS, self.width))
        one /= np.linalg.norm(one, axis=1)[:, None]
        other -= np.einsum("ij,ij->i", one, other)[:, None] * one
        other /= np.linalg.norm(other, axis=1)[:, None]
        other = COSINE * one + math.sqrt(1 - COSINE**2) * other
        self.tables: list[np.ndarray] = []
        met = np.zeros(TRIALS, bool)
        while met.mean() < RECALL and len(self.tables) < MOST_TABLES:
            self.tables.append(random.choice([-1.0, 1.0], size=(hashes, 3, self.width)))
            a, b = (_table_codes(x, self.tables[-1], last) for x in (one, other))
            met |= (a[:, :, None] == b[:, None, :]).any(axis=(1, 2))

    def buckets(self, units: np.ndarray) -> np.ndarray:
        """Names of the buckets of each row, in all tables."""
        rows = np.zeros((len(units), self.width))
        rows[:, : units.shape[1]] = units
        found = []
        for t, signs in enumerate(self.tables):
            codes = _table_codes(rows, signs, self.last).view(np.uint64)
            found.append(mixed(codes * np.uint64(MOST_TABLES) + np.uint64(t) + (np.uint64(units.shape[1]) << np.uint64(48))))
        return np.concatenate(found, axis=1).view(np.int64)

    def sketches(self, units: np.ndarray) -> np.ndarray:
        bits = (units @ self.planes > 0).astype(np.uint64)
        return (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


@lru_cache(maxsize=32)
def layout(count: int, dimension: int) -> Layout:
    return Layout(count, dimension)


def _near(x: Column, y: Column, angle: Column) -> Column:
    """Whether two sketches differ in no more bits than those of vectors at this angle may."""
    share = F.least(angle / math.pi, F.lit(1.0))
    return F.bit_count(x.bitwiseXOR(y)) <= 64 * share + SKETCH_DEVIATIONS * F.sqrt(64 * share * (1 - share))


def _sketched(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """Adds the sketches of the column ``centre``."""
    for batch in batches:
        found = np.zeros(batch.num_rows, np.int64)
        for at, units in _by_width(column(batch, "centre")):
            found[at] = layout(count, units.shape[1]).sketches(units)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "sketch"])


def _units(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _by_width(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors of each length that occurs."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        yield at, _units(vectors.take(pa.array(at)), int(width))


def _bucket_rows(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        classes = column(batch, "cls").to_numpy()
        for at, units in _by_width(column(batch, "vec")):
            plan = layout(count, units.shape[1])
            buckets, sketches = plan.buckets(units), plan.sketches(units)
            per = buckets.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets.ravel()), pa.array(np.repeat(classes[at], per)), pa.array(np.repeat(sketches, per))], names=["bucket", "cls", "sketch"]
            )


def _with_cosine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the columns ``one`` and ``two`` by the cosine of their vectors; null where lengths differ."""
    for batch in batches:
        one, two = column(batch, "one"), column(batch, "two")
        found = np.full(batch.num_rows, np.nan)
        lengths = two.value_lengths().to_numpy(zero_copy_only=False)
        for at, units in _by_width(one):
            same = lengths[at] == units.shape[1]
            if same.any():
                found[at[same]] = np.einsum("ij,ij->i", units[same], _units(two.take(pa.array(at[same])), units.shape[1]))
        kept = [n for n in batch.schema.names if n not in ("one", "two")]
        yield pa.RecordBatch.from_arrays([*[column(batch, n) for n in kept], pa.array(found, mask=np.isnan(found))], names=[*kept, "cos"])


def _cosine(df: DataFrame) -> DataFrame:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in ("one", "two")]
    return df.mapInArrow(_with_cosine, ", ".join([*kept, "cos double"]))


def _compare(members: pa.Table, probing: pa.Table) -> pa.Table:
    """Weights of what each vector of a block and each probing vector links with; a probe from the block's own cell counts for itself only."""
    found = {"cls": [], "links": [], "a": [], "b": []}

    def add(classes, links, a, b) -> None:
        hit = links > 0
        found["cls"].append(classes[hit])
        found["links"].append(links[hit])
        found["a"].append(a[hit])
        found["b"].append(b[hit])

    if members.num_rows and probing.num_rows:
        ids, weights = members["cls"].to_numpy(), members["n"].to_numpy()
        cell = members["cell"].to_numpy()
        probes = probing.combine_chunks()
        total = np.zeros(len(ids), np.int64)
        blocks = list(_by_width(members["vec"].combine_chunks()))
        for at, units in _by_width(probes["vec"].combine_chunks()):
            mine, own, n = probes["cls"].to_numpy()[at], probes["own"].to_numpy()[at], probes["n"].to_numpy()[at]
            for inside, rows in blocks:
                if rows.shape[1] != units.shape[1]:
                    continue
                for first in range(0, len(at), BLOCK):
                    some = slice(first, first + BLOCK)
                    linked = units[some] @ rows.T >= COSINE
                    add(mine[some], linked @ weights[inside], own[some], np.full(len(mine[some]), cell[0]))
                    apart = own[some] != cell[0]
                    total[inside] += (n[some] * apart) @ linked
        add(ids, total, cell, cell)
    types = {"cls": np.int64, "links": np.int64, "a": np.int64, "b": np.int64}
    return pa.table({k: pa.array(np.concatenate(v) if v else np.zeros(0, types[k])) for k, v in found.items()})


def similar_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Links and groups of vectors whose cosine is ``COSINE`` or more.

    Gives one row per row: ``key``, n_links (other rows linked directly), component_id (smallest key
    that links reach, its own included) and kept (``key`` is that smallest key).

    No pair below the threshold is linked; of the pairs at the threshold the tables find about
    ``RECALL``, of closer ones more, and equal vectors always. Vectors that are null, empty or zero
    or hold null or non-finite components have no links and are their own group; so are vectors of
    different lengths towards each other. Equal rows, and rows with equal keys, are vectors of their
    own. A null key stays; its group has the smallest key that is not null, or null. An empty table
    gives an empty table; other columns are not read.

    Classes of equal vectors are known by 128 bits of hashes and travel as one row each.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[vector].dataType
    narrow = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<float>" if narrow else "array<double>").alias("vec"))
    sound = F.size("vec") > 0
    sound &= F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = rows.withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit("other half"), "vec")})

    of_class = rows.where("sound").groupBy("h1", "h2").agg(F.min("key").alias("least"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    classes = written(of_class.withColumn("cls", F.monotonically_increasing_id()), "op11-classes")
    count = classes.count()
    vecs = classes.select("cls", "vec")
    bucket_rows = vecs.mapInArrow(lambda it: _bucket_rows(it, count), "bucket long, cls long, sketch long")
    buckets = written(bucket_rows, "op11-buckets")

    gathered = _gathered(buckets, vecs)
    # A cell is the vectors near a pivot (2 * cls) or those further away (2 * cls + 1), or one vector.
    members = shells = None
    if gathered is not None:
        members, shells = _cells(gathered, classes, count)
        own = members.select("cls", "cell")
        placed = buckets.join(own, "cls", "left")
        alone = placed.where("cell IS NULL").select("bucket", (F.col("cls") * 2).alias("cell"), "sketch", F.lit(0.0).alias("radius"), F.lit(True).alias("single"))
        crowd = placed.where("cell IS NOT NULL").select("bucket", "cell").distinct().join(shells.select("cell", "sketch", "radius"), "cell")
        placed = written(alone.unionByName(crowd.withColumn("single", F.lit(False))), "op11-placed")
    else:
        placed = buckets.select("bucket", (F.col("cls") * 2).alias("cell"), "sketch", F.lit(0.0).alias("radius"), F.lit(True).alias("single"))

    x, y = placed.alias("x"), placed.alias("y")
    near = _near(F.col("x.sketch"), F.col("y.sketch"), F.lit(math.acos(COSINE)) + F.col("x.radius") + F.col("y.radius"))
    met = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.cell") < F.col("y.cell")) & near)
    both = F.col("x.single") & F.col("y.single")
    pairs = written(met.select(F.col("x.cell").alias("a"), F.col("y.cell").alias("b"), both.alias("plain")).distinct(), "op11-pairs")

    plain = pairs.where("plain").select(F.shiftright("a", 1).alias("a"), F.shiftright("b", 1).alias("b"))
    plain = plain.join(vecs.select(F.col("cls").alias("a"), F.col("vec").alias("one")), "a").join(vecs.select(F.col("cls").alias("b"), F.col("vec").alias("two")), "b")
    links = written(_cosine(plain).where(F.col("cos") >= COSINE).select("a", "b"), "op11-links")
    weight = classes.select(F.col("cls").alias("b"), F.col("n").alias("links"))
    both_ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both_ways.join(weight, "b").select(F.col("a").alias("cls"), "links")
    edges = links
    per_cell = None
    if gathered is not None:
        more, more_edges, per_cell = _cell_links(pairs.where("NOT plain"), members, shells, classes)
        counts, edges = counts.unionByName(more), edges.unionByName(more_edges)

    counts = counts.groupBy("cls").agg(F.sum("links").alias("links"))
    found = classes.select("cls", "h1", "h2", "least", "n").join(counts, "cls", "left")
    if gathered is not None:
        found = found.join(members.select("cls", "cell"), "cls", "left")
        # A cell's own links count each member itself, as a single vector's do not.
        found = found.withColumns({"own": F.when(F.col("cell").isNull(), F.col("n")).otherwise(0), "cell": F.coalesce("cell", F.col("cls") * 2)})
        found = found.join(per_cell, "cell", "left").withColumn("node", F.shiftright("cell", 1))
    else:
        found = found.withColumns({"bonus": F.lit(0), "own": F.col("n"), "node": F.col("cls")})
    found = found.withColumn("links", F.coalesce("links", F.lit(0)) + F.coalesce("bonus", F.lit(0)) + F.col("own") - 1)
    found = written(found.select("h1", "h2", "node", "least", F.col("links").alias("n_links")), "op11-found")

    labels = components(edges.where("a <> b"), "op11").withColumnRenamed("label", "group")
    named = found.join(labels, "node", "left").withColumn("group", F.coalesce("group", "node"))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = written(named.join(least, "group").select("h1", "h2", "n_links", "component_id"), "op11-named")
    out = rows.where("sound").select("key", "h1", "h2").join(named, ["h1", "h2"]).select("key", "n_links", "component_id")
    out = out.unionByName(rows.where("NOT sound").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id")))
    return out.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))


def _gathered(buckets: DataFrame, vecs: DataFrame) -> DataFrame | None:
    """(cls, pivot) of the vectors of crowded buckets that link with one of the buckets' pivots; None without such."""
    live, rounds = buckets.select("bucket", "cls"), []
    for step in range(ROUNDS):
        crowd = live.groupBy("bucket").agg(F.count("*").alias("c"), F.min(F.struct(F.xxhash64("cls", F.lit(step)).alias("h"), "cls")).alias("p"))
        crowd = written(crowd.where(F.col("c") > CROWDED).select("bucket", F.col("p.cls").alias("pivot")), "op11-crowded")
        if crowd.isEmpty():
            break
        live = written(live.join(crowd.select("bucket"), "bucket", "left_semi"), "op11-live")
        tried = live.join(crowd, "bucket").select("cls", "pivot").distinct()
        tried = tried.join(vecs.withColumnRenamed("vec", "one"), "cls").join(vecs.select(F.col("cls").alias("pivot"), F.col("vec").alias("two")), "pivot")
        best = _cosine(tried).where((F.col("cos") >= COSINE) | (F.col("cls") == F.col("pivot")))
        best = best.groupBy("cls").agg(F.max(F.struct("cos", -F.col("pivot"))).alias("best")).select("cls", (-F.col("best.col2")).alias("pivot"))
        rounds.append(written(best, "op11-gathered"))
        live = live.join(rounds[-1].select("cls"), "cls", "left_anti")
    out = None
    for found in rounds:
        out = found if out is None else out.unionByName(found)
    return out


def _cells(gathered: DataFrame, classes: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """Members of the cells, with the angle to the cell's centre; and the cells with centre, radius, size and weight.

    The centre is the mean direction of all vectors around a pivot. Those within half the threshold's
    angle of it are one cell, in which all link; the others are a second one.
    """
    half = math.acos(COSINE) / 2 - MARGIN
    rows = written(gathered.join(classes.select("cls", "n", "vec"), "cls"), "op11-gathered-vectors")
    sums = rows.select("pivot", F.posexplode("vec").alias("i", "x"), F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v)).alias("norm"))
    # Partial sums before the exchange: a task sends a row per pivot and component.
    sums = sums.groupBy("pivot", "i").agg(F.sum(F.col("x") / F.col("norm")).alias("x"))
    centres = sums.groupBy("pivot").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("xs"))
    centres = written(centres.select("pivot", F.transform("xs", lambda s: s["x"]).alias("centre")), "op11-centres")
    # A mean of nothing but opposite or overflowing vectors gives no direction: then the pivot itself does.
    usable = F.forall("centre", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("centre", lambda x: F.abs(x) > 1e-9)
    pivots = classes.select(F.col("cls").alias("pivot"), F.col("vec").cast("array<double>").alias("own"))
    centres = centres.join(pivots, "pivot").select("pivot", F.when(usable, F.col("centre")).otherwise(F.col("own")).alias("centre"))
    placed = _cosine(rows.join(centres, "pivot").withColumnsRenamed({"vec": "one", "centre": "two"}).select("cls", "pivot", "n", "one", "two"))
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cos"))))
    placed = placed.withColumn("angle", angle).withColumn("cell", F.col("pivot") * 2 + F.when(F.col("angle") <= half, 0).otherwise(1))
    members = written(placed.select("cls", "cell", "n", "angle"), "op11-members")
    shells = members.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("size"), F.sum("n").alias("weight"))
    shells = shells.withColumn("pivot", F.shiftright("cell", 1)).join(centres, "pivot").select("cell", "radius", "size", "weight", "centre")
    sketched = "cell long, radius double, size long, weight long, centre array<double>, sketch long"
    return members, written(shells.mapInArrow(lambda it: _sketched(it, count), sketched), "op11-cells")


def _cell_links(pairs: DataFrame, members: DataFrame, shells: DataFrame, classes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links that a cell has part in: (cls, links) to be summed, edges between pivots, and (cell, bonus): links of all its members."""
    shells = shells.drop("sketch")
    limit = math.acos(COSINE)
    # Single vectors that meet a cell are cells of one, with radius 0.
    ends = pairs.select(F.col("a").alias("cell")).unionByName(pairs.select(F.col("b").alias("cell"))).distinct()
    alone = ends.join(shells.select("cell"), "cell", "left_anti").withColumn("cls", F.shiftright("cell", 1))
    alone = alone.join(classes.select("cls", "n", "vec"), "cls")
    rows = members.join(classes.select("cls", "vec"), "cls").unionByName(alone.select("cls", "cell", "n", F.lit(0.0).alias("angle"), "vec"))
    rows = written(rows, "op11-cell-rows")
    cells = shells.unionByName(alone.select("cell", F.lit(0.0).alias("radius"), F.lit(1).cast("long").alias("size"), F.col("n").alias("weight"), F.col("vec").cast("array<double>").alias("centre")))
    cells = written(cells, "op11-all-cells")

    # Both cells of a pivot always meet.
    twins = shells.where("cell % 2 = 0").select(F.col("cell").alias("a"), (F.col("cell") + 1).alias("b")).join(shells.select(F.col("cell").alias("b")), "b")
    pairs = pairs.select("a", "b").unionByName(twins.select("a", "b")).distinct()

    def side(name: str) -> DataFrame:
        return cells.select(*[F.col(c).alias(name if c == "cell" else f"{c}_{name}") for c in cells.columns])

    met = pairs.join(side("a"), "a").join(side("b"), "b").withColumnsRenamed({"centre_a": "one", "centre_b": "two"})
    met = _cosine(met).withColumn("angle", F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cos")))))
    reach = F.col("radius_a") + F.col("radius_b")
    met = met.withColumn("all", F.col("angle") + reach <= limit - MARGIN).where(F.col("angle") - reach <= limit + MARGIN)
    swap = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") > F.col("b")))
    met = met.select(
        F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b"),
        F.when(swap, F.col("weight_b")).otherwise(F.col("weight_a")).alias("weight_a"),
        F.when(swap, F.col("weight_a")).otherwise(F.col("weight_b")).alias("weight_b"),
        "all",
    )
    inner = shells.select(F.col("cell").alias("a"), F.col("cell").alias("b"), F.col("weight").alias("weight_a"), F.col("weight").alias("weight_b"), (2 * F.col("radius") <= limit - MARGIN).alias("all"))
    met = written(met.unionByName(inner), "op11-cell-pairs")
    whole = met.where("all")
    bonus = whole.select(F.col("a").alias("cell"), F.col("weight_b").alias("bonus")).unionByName(whole.where("a <> b").select(F.col("b").alias("cell"), F.col("weight_a").alias("bonus")))

    # Members of the smaller cell against the centre of the larger one.
    part = met.where("NOT all").select("a", "b").join(cells.select(F.col("cell").alias("a"), "radius", "size", "weight", F.col("centre").alias("two")), "a")
    part = part.join(rows.select(F.col("cell").alias("b"), "cls", "n", F.col("vec").alias("one")), "b").withColumn("vec", F.col("one"))
    part = _cosine(part).withColumn("angle", F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("cos")))))
    part = written(part.where(F.col("angle") - F.col("radius") <= limit + MARGIN).withColumn("all", F.col("angle") + F.col("radius") <= limit - MARGIN), "op11-cell-parts")
    whole_part = part.where("all")
    bonus = bonus.unionByName(whole_part.where("a <> b").select(F.col("a").alias("cell"), F.col("n").alias("bonus")))
    counts = whole_part.select("cls", F.col("weight").alias("links"))

    # What is left, in units of a block of the larger cell and some of the probing vectors.
    open_ = part.where("NOT all")
    units = open_.groupBy("a").agg(F.ceil(F.max("size") / BLOCK).alias("blocks"), F.ceil(F.count("*") / PROBED).alias("shares"))
    units = written(units, "op11-units")
    probing = open_.select(F.col("a").alias("cell"), F.col("b").alias("own"), "cls", "n", "vec").join(units.withColumnRenamed("a", "cell"), "cell")
    probing = probing.withColumns({"share": F.pmod(F.xxhash64("cls", F.lit(1)), "shares"), "block": F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))})
    blocks = rows.select("cell", "cls", "n", "vec").join(units.withColumnRenamed("a", "cell"), "cell")
    blocks = blocks.withColumns({"block": F.pmod(F.xxhash64("cls"), "blocks"), "share": F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1))})
    unit = ["cell", "block", "share"]
    compared = blocks.drop("blocks", "shares").groupBy(*unit).cogroup(probing.drop("blocks", "shares").groupBy(*unit)).applyInArrow(_compare, _EDGE)
    compared = written(compared, "op11-compared")
    counts = counts.unionByName(compared.select("cls", "links"))

    def edge(frame: DataFrame) -> DataFrame:
        return frame.select(F.shiftright("a", 1).alias("a"), F.shiftright("b", 1).alias("b")).distinct()

    edges = edge(whole).unionByName(edge(whole_part)).unionByName(edge(compared))
    return counts, edges, bonus.groupBy("cell").agg(F.sum("bonus").alias("bonus"))


def op11_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return similar_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP11_SQL = f"""
WITH RECURSIVE k AS (
  SELECT vec_id, row_number() OVER () AS r, embedding::DOUBLE[] AS v,
    embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(embedding, lambda c: c <> 0)) > 0 AS sound
  FROM embeddings),
e AS (
  SELECT x.r AS a, y.r AS b FROM k AS x JOIN k AS y ON x.r <> y.r AND x.sound AND y.sound AND len(x.v) = len(y.v)
  WHERE CASE WHEN len(x.v) = len(y.v) THEN list_cosine_similarity(x.v, y.v) END >= {COSINE}),
reach AS (SELECT r AS a, r AS b FROM k UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b),
g AS (SELECT reach.a AS r, min(k.vec_id) AS component_id FROM reach JOIN k ON k.r = reach.b GROUP BY reach.a)
SELECT k.vec_id, (SELECT count(*) FROM e WHERE e.a = k.r) AS n_links, g.component_id, k.vec_id IS NOT DISTINCT FROM g.component_id AS kept
FROM k JOIN g USING (r)
"""
