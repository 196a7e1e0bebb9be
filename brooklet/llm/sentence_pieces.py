"""Encoding with a SentencePiece BPE vocabulary, and decoding, through a trie of marked words.

The distinct words of many texts, each with its mark ``▁``, are walked in sorted order, which is a
depth-first walk of their trie. The forward table holds, for each prefix on the path, the last
piece of the prefix's segmentation; words that share a prefix share that part of the table, and
the pieces of a word are read back from its end. As the vocabulary's scores rank merges instead of
being probabilities, the forward step is not a sum of scores but the rule that gives the segmentation
of merging: a piece may follow another one if merging leaves the two of them as they are.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence, Set
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from brooklet.llm.common import column

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Characters of text that one walk of the trie takes at least; a longer text is a walk of its own.
WALK_CHARS = 4 << 20
#: Pairs of pieces, and words, that a Python worker remembers, before it forgets them all.
REMEMBERED = 600_000
REMEMBERED_WORDS = 200_000

_UNITS = re.compile(f"{MARK}?[^{MARK}\n]+|{MARK}{{2,}}[^{MARK}\n]*|{MARK}|\n")


class Vocabulary:
    """Pieces, their merge scores and ids, as plain values that tasks can share."""

    def __init__(self, path: str = MODEL):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        odd = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(size)]
        self.ids = {p: i for i, (p, o) in enumerate(zip(pieces, odd, strict=True)) if not o}
        self.pieces = pieces
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.bytes = {b: model.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.unknown = model.unk_id()
        back = {i: bytes([b]) for b, i in self.bytes.items()}
        control = {i for i in range(size) if model.is_control(i)}
        self.texts = [b"" if i in control else back.get(i, p.replace(MARK, " ").encode()) for i, p in enumerate(pieces)]
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("pieces must not hold line feeds, nor the mark but at their start")
        lengths: dict[str, set[int]] = {}
        for p in self.ids:
            if len(p) > 2:
                lengths.setdefault(p[-3:], set()).add(len(p))
        #: Lengths of the pieces with the same last three characters, longest first, and that of two characters.
        self.ends = {end: (*sorted(n, reverse=True), 2) for end, n in lengths.items()}
        self.run = max((len(p) for p in self.ids if not p.strip(MARK)), default=1)


class Walk:
    """The forward table along a path of the trie.

    It is what tasks share: a worker keeps what it remembers from task to task of a job, and forgets it
    with the broadcast, so that other stages have the memory.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, list[int]] = {}

    def merged(self, text: str) -> list[str]:
        """Plain merging: of all neighbours that form a piece those with the best score, the first of them, become one."""
        parts, scores = list(text), self.v.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the texts of two pieces gives these two; without a first one, whether it gives the second."""
        if len(self.pairs) > REMEMBERED:
            self.pairs.clear()
        first = [self.v.pieces[a]] if a >= 0 else []
        found = self.pairs[a << 32 | b] = self.merged("".join(first) + self.v.pieces[b]) == [*first, self.v.pieces[b]]
        return found

    def of_piece(self, piece: str) -> list[int]:
        known = self.v.ids.get(piece)
        return [known] if known is not None else [self.v.bytes.get(b, self.v.unknown) for b in piece.encode("utf-8", "surrogatepass")]

    def words(self, units: set[str]) -> dict[str, list[int]]:
        """Ids of distinct units, in one depth-first walk.

        ``last`` and ``size`` are the forward table: the last piece of each prefix, -1 where that is
        a character without a piece, and its length.
        """
        ids, ends, pairs, follows = self.v.ids.get, self.v.ends.get, self.pairs.get, self.follows
        out: dict[str, list[int]] = {}
        last, size, two = [-1], [0], (2,)
        before = ""
        for unit in sorted(units):
            shared = 0
            for x, y in zip(before, unit, strict=False):
                if x != y:
                    break
                shared += 1
            del last[shared + 1 :], size[shared + 1 :]
            for i in range(shared + 1, len(unit) + 1):
                for n in ends(unit[i - 3 : i], two) if i > 2 else two:
                    if n <= i and (piece := ids(unit[i - n : i])) is not None:
                        front = last[i - n]
                        if (fits := pairs(front << 32 | piece)) is None:
                            fits = follows(front, piece)
                        if fits:
                            last.append(piece)
                            size.append(n)
                            break
                else:
                    last.append(ids(unit[i - 1], -1))
                    size.append(1)
            found: list[int] = []
            at = len(unit)
            while at:
                if last[at] >= 0:
                    found.append(last[at])
                else:
                    found.extend(reversed(self.of_piece(unit[at - 1])))
                at -= size[at]
            found.reverse()
            out[unit] = found
            before = unit
        return out

    def units(self, units: Set[str]) -> dict[str, list[int]]:
        """Ids of units, of which the task has walked some already."""
        if len(self.known) > REMEMBERED_WORDS:
            self.known.clear()
        self.known.update(self._units(units - self.known.keys()))
        return self.known

    def _units(self, units: set[str]) -> dict[str, list[int]]:
        """Ids of marked words, and of those behind several marks; a run of marks is taken from its start in the longest pieces."""
        plain = {u for u in units if not u.startswith(MARK * 2)}
        runs = units - plain
        out = self.words(plain | {MARK + u.lstrip(MARK) for u in runs})
        mark = self.of_piece(MARK)
        for u in runs:
            rest = out[MARK + u.lstrip(MARK)]
            n = len(u) - len(u.lstrip(MARK)) - 1
            if rest[: len(mark)] == mark:
                n, rest = n + 1, rest[len(mark) :]
            out[u] = [x for k in range(0, n, self.v.run) for x in self.of_piece(MARK * min(self.v.run, n - k))] + rest
        return out


def _encoded(texts: list[str], walk: Walk) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and ids of several texts."""
    number: defaultdict[str, int] = defaultdict(count().__next__)
    rows: list[np.ndarray] = []
    for text in texts:
        found = _UNITS.findall(MARK + text.replace(" ", MARK)) if text else []
        rows.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
    ids = walk.units(number.keys())
    lists = list(map(ids.__getitem__, number))
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    start = np.cumsum(size) - size
    flat = np.fromiter(chain.from_iterable(lists), np.int32, int(size.sum()))
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    n = size[at]
    place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[at], n)
    ends = np.cumsum([int(size[r].sum()) for r in rows])
    return np.concatenate([[0], ends]).astype(np.int32), flat[place]


def _encode_rows(batches: Iterator[pa.RecordBatch], walk: Walk) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in column(batch, "text").to_pylist()]
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= WALK_CHARS):
                size += len(texts[last])
                last += 1
            offsets, ids = _encoded(texts[first:last], walk)
            others = [column(batch, c).slice(first, last - first) for c in batch.schema.names if c != "text"]
            names = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*others, pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))], names=[*names, "ids"])
            first = last


def _decode_rows(batches: Iterator[pa.RecordBatch], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = column(batch, "ids")
        bounds, flat = ids.offsets.to_pylist(), ids.values.to_numpy()
        out = []
        for a, b in zip(bounds, bounds[1:], strict=False):
            text = b"".join(map(texts.__getitem__, flat[a:b].tolist()))
            out.append((text[1:] if text[:1] == b" " else text).decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "decoded"])


def encode(docs: DataFrame, model: str = MODEL, carry: Sequence[str] = ()) -> DataFrame:
    """``ids`` in place of ``text``, behind ``doc_id`` and the columns that ``carry`` names.

    ids are those that the vocabulary's own library gives for the whole text, special strings taken
    as ordinary text. Null and empty texts have no ids; a null id stays; repeated rows are encoded
    one by one; an empty table gives an empty table; other columns are not read. A walk of the trie
    takes the words of about ``WALK_CHARS`` characters, or of one longer text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Walk(Vocabulary(model)))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").cast("string").alias("text"))
    schema = StructType([*source.schema.fields[:-1], StructField("ids", ArrayType(IntegerType()))])
    return source.mapInArrow(lambda it: _encode_rows(it, shared.value), schema)


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``decoded``, the text of ``ids``, beside the columns doc_id and ids.

    It is the text that was encoded, but for a mark character in that text, which comes back as a
    blank. No ids give an empty text.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(model).texts)
    source = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return source.mapInArrow(lambda it: _decode_rows(it, shared.value), "doc_id long, ids array<int>, decoded string")


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    both = decode(encode(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_ids"), ids.alias("ids_sha256"), F.length("decoded").cast("long").alias("decoded_chars"), F.sha2("decoded", 256).alias("decoded_sha256"))
