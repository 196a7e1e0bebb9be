"""A Merkle tree over a table: a leaf per row, a tree per group, and a tree over the groups' roots.

Rows get their places by one range exchange, so no group is one task's work. A level is one window
over runs of siblings: lags and leads of fixed offsets, masked by the place in the run and by the
run's length, are a node's siblings, and the first child of a run hashes its parent. Levels shrink by
the width of a run, so all but the leaves cost little. Paths travel down the same way: a run takes
its parent's path and puts its own siblings in front.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brooklet.llm.common import written

#: Children of a node.
WIDTH = 16
#: Columns that make a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows, of about a hundred bytes, that one task puts in order.
ROWS_PER_TASK = 2_000_000
#: One row in so many is tampered with.
TAMPERED = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_INDEX_BITS = 33  # of monotonically_increasing_id: the row's place in its partition


def _hashed(digests: Column) -> Column:
    """Digest of the concatenation of digests, which are hashed as lower-case hex text."""
    return F.unhex(F.sha2(F.lower(F.hex(digests)), 256))


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 length, a colon and itself, ``-`` for null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _placed(rows: DataFrame, group: str | None, order: list[str], name: str) -> DataFrame:
    """The rows with ``gid`` (a number per group, ascending with it), ``pos`` (place in it) and ``total`` (its rows).

    Only the sizes of groups per partition are ranked in a window, at most one row for each of both.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_TASK))
    by = [c for c in (group, *order) if c]
    ordered = rows.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered.withColumn("task", F.shiftright("at", _INDEX_BITS)), f"{name}-ordered")
    keys = [group] if group else []
    parts = ordered.groupBy("task", *keys).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("task").alias("part"),
        *[F.col(k).alias("part_group") for k in keys],
        "first",
        F.min("first").over(whole).alias("gid"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(whole).alias("total"),
    )
    same = F.col("task") == F.col("part")
    if group:
        same &= F.col(group).eqNullSafe(F.col("part_group"))
    return ordered.join(parts, same).select(*rows.columns, "gid", (F.col("at") - F.col("first") + F.col("before")).alias("pos"), "total")


def _with_siblings(nodes: DataFrame, before: bool = True) -> DataFrame:
    """Nodes with ``run``, ``slot`` and the digests of their siblings: ``left`` and ``right`` of them, as one value each."""
    nodes = nodes.withColumns({"run": F.floor(F.col("pos") / WIDTH), "slot": F.pmod("pos", F.lit(WIDTH))})
    nodes = nodes.withColumn("length", F.least(F.lit(WIDTH), F.col("total") - F.col("run") * WIDTH))
    run = "OVER (PARTITION BY gid, run ORDER BY slot)"
    lags = [f"CASE WHEN slot >= {i} THEN lag(digest, {i}) {run} ELSE X'' END" for i in range(WIDTH - 1, 0, -1)]
    leads = [f"CASE WHEN slot + {i} < length THEN lead(digest, {i}) {run} ELSE X'' END" for i in range(1, WIDTH)]
    left = [f"concat({', '.join(lags)}) AS left"] if before else []
    return nodes.selectExpr("*", *left, f"concat({', '.join(leads)}) AS right")


def _parents(nodes: DataFrame) -> DataFrame:
    """One node for each run: the first child hashes itself and its siblings."""
    first = _with_siblings(nodes.select("gid", "pos", "total", "digest"), before=False).where("slot = 0")
    return first.select("gid", F.col("run").alias("pos"), F.ceil(F.col("total") / WIDTH).alias("total"), _hashed(F.concat("digest", "right")).alias("digest"))


def _levels(leaves: DataFrame, name: str) -> list[DataFrame]:
    """All levels, from the leaves on; a group is in as many as its tree has, its last node having total 1."""
    levels = [leaves]
    most = leaves.agg(F.max("total")).first()[0] or 0
    while most > 1:
        levels.append(written(_parents(levels[-1].where("total > 1")), f"{name}-level"))
        most = -(-most // WIDTH)
    return levels


def _paths(levels: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The leaves with the columns of ``above`` (by ``gid``) and ``path``: siblings level by level up to the root."""
    rest = [c for c in above.columns if c not in ("gid", "path")]
    found = None
    for depth in range(len(levels) - 1, -1, -1):
        nodes = levels[depth]
        kept = [c for c in nodes.columns if c not in ("gid", "pos", "total", "digest")]
        alone = nodes.where("total = 1").join(above, "gid")
        out = alone.select("gid", "pos", "total", "digest", *kept, "path", *rest)
        if found is not None:
            upper = found.select(F.col("gid").alias("up_gid"), F.col("pos").alias("up_run"), F.col("path").alias("up"), *rest)
            own = _with_siblings(nodes.where("total > 1"))
            own = own.join(upper, (F.col("gid") == F.col("up_gid")) & (F.col("run") == F.col("up_run")))
            path = F.concat(F.array(F.struct("left", "right")), F.col("up"))
            out = out.unionByName(own.select("gid", "pos", "total", "digest", *kept, path.alias("path"), *rest))
        found = written(out, f"{name}-paths") if depth else out
    return found


def merkle_manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    changed: Column | None = None,
    changed_fields: Sequence[Column] = (),
) -> DataFrame:
    """Leaf, roots and proof of every row, and the root that its proof gives.

    Leaves ascend by ``key`` within a ``group``; runs of ``WIDTH`` consecutive nodes (the last may be
    shorter, even one) become their parent while a group has several nodes. The groups' roots,
    ordered by group, are the leaves of the last tree. Where ``changed`` holds, the proof is checked
    against the leaf of ``changed_fields`` instead of the row's own.

    Gives one row per row: ``key``, leaf, subroot, root, proof (digests of the siblings, level by level,
    left to right, as one binary value), proof_sha256, folded_root, verified; digests as lower-case
    hex text, hashed as such.

    A null field has its own mark, so it differs from an empty text. A null group is a group, the
    first one; null keys come first in their group. Rows with equal keys are ordered by their leaves,
    and equal rows are each a leaf. A lone leaf is its group's root, and a lone group's root is the
    root. An empty table gives an empty table; other columns are not read.
    """
    leaf = leaf_digest([F.col(f) for f in fields])
    other = F.lit(None).cast("binary") if changed is None else F.when(changed, leaf_digest(changed_fields))
    rows = docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("own_group"), leaf.alias("digest"), other.alias("other"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "op12-leaves")
    leaves = _placed(rows, "own_group", ["key", "digest", "row"], "op12").drop("own_group", "row")
    levels = _levels(leaves, "op12")

    subroots = written(_union([nodes.where("total = 1").select(F.col("gid").alias("key"), F.col("digest").alias("digest")) for nodes in levels]), "op12-subroots")
    tops = _levels(_placed(subroots, None, ["key"], "op12-top"), "op12-top")
    root = tops[-1].where("total = 1").select("gid", F.col("digest").alias("root"), F.array().cast("array<struct<left: binary, right: binary>>").alias("path"))
    above = written(_paths(tops, root, "op12-top").select(F.col("key").alias("gid"), "path", F.col("digest").alias("subroot"), "root"), "op12-above")

    found = _paths(levels, above, "op12")
    proof = F.aggregate("path", F.lit(b""), lambda out, p: F.concat(out, p["left"], p["right"]))
    folded = F.aggregate("path", F.coalesce("other", "digest"), lambda d, p: _hashed(F.concat(p["left"], d, p["right"])))
    found = found.select("key", "digest", "subroot", "root", proof.alias("proof"), folded.alias("folded"))
    return found.select(
        F.col("key").alias(key),
        _text(F.col("digest")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        _text(F.col("root")).alias("root"),
        "proof",
        F.sha2(_text(F.col("proof")), 256).alias("proof_sha256"),
        _text(F.col("folded")).alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def op12_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(TAMPERED)) == 0
    lowered = [F.translate("text", _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS]
    return merkle_manifest(docs, changed=chosen, changed_fields=lowered).drop("proof")


_SQL_DEPTH = 7


def _sql_tree(prefix: str, source: str) -> str:
    """Levels of a tree as SQL, from ``source`` (g, pos, total, h), and the path of every leaf."""
    level = "\n".join(
        f"""{prefix}{k} AS (
  SELECT g, pos // {WIDTH} AS pos, (total + {WIDTH - 1}) // {WIDTH} AS total, sha256(string_agg(h, '' ORDER BY pos)) AS h
  FROM {prefix}{k - 1} WHERE total > 1 GROUP BY g, pos // {WIDTH}, total),"""
        for k in range(1, _SQL_DEPTH)
    )
    sides = "\n".join(
        f"""{prefix}s{k} AS (
  SELECT g, pos, coalesce(string_agg(h, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {prefix}{k} WHERE total > 1 WINDOW run AS (PARTITION BY g, pos // {WIDTH} ORDER BY pos)),"""
        for k in range(_SQL_DEPTH - 1)
    )
    lists = ", ".join(f"CASE WHEN s{k}.g IS NOT NULL THEN {{'l': s{k}.l, 'r': s{k}.r}} END" for k in range(_SQL_DEPTH - 1))
    joins = "\n".join(f"  LEFT JOIN {prefix}s{k} AS s{k} ON s{k}.g = x.g AND s{k}.pos = x.pos // {WIDTH**k}" for k in range(_SQL_DEPTH - 1))
    tops = " UNION ALL ".join(f"SELECT g, h FROM {prefix}{k} WHERE total = 1" for k in range(_SQL_DEPTH))
    return f"""{prefix}0 AS ({source}),
{level}
{sides}
{prefix}path AS (
  SELECT x.g, x.pos, x.h, list_filter([{lists}], lambda e: e IS NOT NULL) AS path
  FROM {prefix}0 AS x
{joins}),
{prefix}root AS ({tops})"""


def _sql_leaf(text: str) -> str:
    parts = [text if f == "text" else f"CAST({f} AS VARCHAR)" for f in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen({p}) AS VARCHAR) || ':' || {p}, '-')" for p in parts) + ")"


#: CRC-32 of the decimal text of doc_id, bit by bit.
_SQL_CRC = """xor(4294967295, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP12_SQL = f"""
WITH
t AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
    CASE WHEN {_SQL_CRC} % {TAMPERED} = 0 THEN {_sql_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS other
  FROM documents),
p AS (
  SELECT doc_id, leaf, coalesce(other, leaf) AS other, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS total
  FROM t),
{_sql_tree("a", "SELECT g, pos, total, leaf AS h FROM p")},
{_sql_tree("b", "SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS total, h FROM aroot")},
f AS (
  SELECT p.doc_id, p.leaf, p.other, u.h AS subroot, r.h AS root, list_concat(x.path, y.path) AS path
  FROM p JOIN apath AS x ON x.g = p.g AND x.pos = p.pos JOIN aroot AS u ON u.g = p.g JOIN bpath AS y ON y.pos = p.g - 1, broot AS r),
c AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda e: e.l || e.r), '')) AS proof_sha256,
    list_reduce(list_concat([{{'l': other, 'r': ''}}], path), lambda d, e: {{'l': sha256(e.l || d.l || e.r), 'r': ''}}).l AS folded_root
  FROM f)
SELECT *, folded_root = root AS verified FROM c
"""
