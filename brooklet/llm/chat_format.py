"""Chat formatting as a prefix tree.

Conversations that begin with the same turns share the nodes of these turns. The tree's tokens, here
characters of the formatted turns, stand once in one depth-first stream. Each node carries its
position in a conversation, and each conversation the intervals of the stream that it may attend to.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brooklet.llm.common import column, written

# The template's control strings.
BEGIN, MIDDLE, END = "<s>", "[/INST]", "</s>"
LEARNED = "assistant"

_CONTROL = re.compile(r"([<\[])(\\*)(?=/?s>|/?INST\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(?=/?s>|/?INST\])")
_NULL_ID = -(1 << 63)

_TURNS = "conv long, depth int, node string, parent string, learned boolean, segment string, loss_from int, loss_to int, position long"


def escaped(text: str) -> str:
    """A backslash more after the bracket of whatever could be read as a control string."""
    return _CONTROL.sub(r"\1\\\2", text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def _turn_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formats turns sorted by conversation, and names each by the turns up to it."""
    conv, depth, node, position = None, 0, "", 0
    for batch in batches:
        out: list[list] = [[] for _ in range(9)]
        for row in batch.to_pylist():
            if row["conv"] != conv:
                conv, depth, node, position = row["conv"], 0, "", 0
            role, text = row["role"], row["text"]
            head = BEGIN + escaped(role) + MIDDLE
            body = escaped(text)
            segment = head + body + END
            parent, node = node, hashlib.blake2b(f"{node}\n{len(role)}\n{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()
            values = (conv, depth, node, parent, role == LEARNED, segment, len(head), len(head) + len(body), position)
            for column_, value in zip(out, values, strict=True):
                column_.append(value)
            depth, position = depth + 1, position + len(segment)
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], names=[x.split()[0] for x in _TURNS.split(", ")])


def _in_order(df: DataFrame, key: list[Column], size: str, name: str) -> DataFrame:
    """Adds ``start``: the sum of ``size`` over all rows before by ``key``.

    Rows are sorted into ranges, each range is summed by itself, and the sums of whole ranges, one
    row each, give where a range begins.
    """
    ranged = written(df.repartitionByRange(*key).withColumn("_range", F.spark_partition_id()), name)
    inner = Window.partitionBy("_range").orderBy(*key)
    running = ranged.withColumn("_sum", F.sum(size).over(inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    totals = ranged.groupBy("_range").agg(F.sum(size).alias("total"))  # a row per range
    begins = totals.withColumn("_begin", F.sum("total").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("total"))
    return running.join(F.broadcast(begins.select("_range", "_begin")), "_range").withColumn("start", F.col("_begin") + F.col("_sum") - F.col(size)).drop("_range", "_begin", "_sum")


def prefix_tree(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the tree, and conversations with what they attend to.

    Nodes: node, parent ("" for a first turn), owner (the smallest conversation through it), depth,
    segment, start (of the segment in the stream), size, position (of its first character in each
    of its conversations), learned, loss_from and loss_to (the text under the loss mask, within the
    segment). Conversations: conv and attends, the ancestors' intervals of the stream in order.

    Turns of a conversation go by turn, then role, then text. A null text or role is empty; rows
    that repeat a turn are turns of their own; rows without a conv_id are one conversation, its id
    the smallest long; an empty table gives two empty tables; other columns are not read.
    """
    source = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_NULL_ID)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turns = written(source.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(_turn_rows, _TURNS), "op4-turns")

    # Children go by the smallest conversation below them. So the stream is that of the conversations
    # in a depth-first order, each with the nodes of which it is the smallest one, its own nodes.
    same = ("segment", "depth", "parent", "learned", "loss_from", "loss_to", "position")
    nodes = written(turns.groupBy("node").agg(F.min("conv").alias("owner"), *[F.first(c).alias(c) for c in same]), "op4-nodes")
    path = turns.select("conv", "depth", "node").join(nodes.select("node", "owner"), "node")
    parts = path.groupBy("conv", "owner").agg(F.count("*").alias("turns"))
    order = parts.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("owner", (-F.col("turns")).alias("less")))).alias("route"))
    sizes = nodes.groupBy(F.col("owner").alias("conv")).agg(F.sum(F.length("segment")).cast("long").alias("size"))
    begins = _in_order(order.join(sizes, "conv"), [F.col("route"), F.col("conv")], "size", "op4-order").select(F.col("conv").alias("owner"), F.col("start").alias("begin"))
    own = Window.partitionBy("owner").orderBy("depth")
    nodes = nodes.withColumn("size", F.length("segment").cast("long"))
    nodes = nodes.withColumn("before", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    nodes = written(nodes.join(begins, "owner").withColumn("start", F.col("begin") + F.col("before")).drop("begin", "before"), "op4-stream")

    # The nodes of one owner on a path stand side by side in the stream: one interval.
    spans = turns.select("conv", "node").join(nodes.select("node", "owner", "start", "size"), "node").groupBy("conv", "owner").agg(F.min("start").alias("from"), F.max(F.col("start") + F.col("size")).alias("to"))
    attends = spans.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("from", "to", "owner"))).alias("attends"))
    return nodes, attends


def _read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads conversations back from their segments, which come in order."""
    conv, state = None, None

    def done() -> list:
        n, turns, learned, loss, size = state
        return [conv, n, turns.hexdigest(), loss, learned.hexdigest(), size]

    out: list[list] = []
    for batch in batches:
        for row in batch.to_pylist():
            if state is None or row["conv"] != conv:
                if state is not None:
                    out.append(done())
                conv, state = row["conv"], [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
            segment = row["segment"]
            role, _, text = segment[len(BEGIN) : -len(END)].partition(MIDDLE)
            state[0] += 1
            state[1].update(f"{unescaped(role)}\n{unescaped(text)}\n".encode("utf-8", "surrogatepass"))
            if row["learned"]:
                taught = unescaped(segment[row["loss_from"] : row["loss_to"]])
                state[2].update(taught.encode("utf-8", "surrogatepass"))
                state[3] += len(taught)
            state[4] += len(segment)
        yield _read_batch(out)
        out = []
    if state is not None:
        yield _read_batch([done()])


def _read_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_back(nodes: DataFrame, attends: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars of each conversation, from the stream alone."""
    spans = attends.select("conv", F.explode("attends").alias("x")).select("conv", "x.owner", "x.from", "x.to")
    seen = spans.join(nodes.select("owner", "start", "position", "segment", "learned", "loss_from", "loss_to"), "owner").where("start >= from AND start < to")
    seen = seen.select("conv", "position", "segment", "learned", "loss_from", "loss_to").repartition("conv").sortWithinPartitions("conv", "position")
    read = seen.mapInArrow(_read_rows, "conv long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    return read.select(F.when(F.col("conv") != _NULL_ID, F.col("conv")).alias("conv_id"), *read.columns[1:])


def op4_chat_formatting(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = f"{END}[INST] ok {MIDDLE}"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise(LEARNED).alias("role"), F.lit(hard).alias("text"))
    return read_back(*prefix_tree(rows.unionByName(extra)))


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + length(role) + length(text) + len(regexp_extract_all(role, '[<\[]\\*(/?s>|/?INST\])')) + len(regexp_extract_all(text, '[<\[]\\*(/?s>|/?INST\])')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
