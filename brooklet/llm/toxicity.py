"""Toxicity scores of deobfuscated text.

Spellings such as ``1d!ot``, ``i d i o t`` and ``iiidiot`` are noise on a channel. Every such unit
becomes a lattice of what its characters may stand for, and a Viterbi search under a character
trigram model of the whole corpus picks the likeliest reading. Words and word beginnings of the
restored text are the features of a logistic regression.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brooklet.llm.common import chunks, column, written

#: Most labelled rows that the classifier is fitted on, those with the smallest hash of the id.
SAMPLE = 20_000
#: Features of the classifier, and toxic rows of the sample that a feature needs.
FEATURES, SUPPORT = 1000, 5
#: Features that are counted on all rows of the sample: those with most toxic rows.
CANDIDATES = 50_000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
RIDGE = 0.2
#: Tokens that a task remembers the features of, before it forgets them all.
REMEMBERED = 150_000
#: Texts that become Python strings at once.
SLICE = 500

# What leetspeak writes for a letter.
LEET = {
    "0": "o",
    "1": "il",
    "2": "z",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "gb",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "il",
    "|": "il",
    "+": "t",
    "(": "c",
    "€": "e",
    "£": "l",
}
SEPARATORS = " .-_*'~"
#: Log-probabilities of the channel: a substitution, a separator inside a word, a letter said again.
SWAP, JOIN, AGAIN = -1.0, -0.5, -0.7

_CLASSES = np.full(256, 27, np.int64)
_CLASSES[97:123] = _CLASSES[65:91] = np.arange(1, 27)
_CLASSES[[32, *range(9, 14)]] = 0
_CLASSES[128:] = 28
_SIZE = 32

_WORDS = re.compile(r"[^\W\d_]+")
_EDGES = re.compile(r"^[^\w@$]+|[\W_]+$")
#: What no reading of a token begins or ends with: neither a letter nor what LEET writes for one.
_MARKS = "".join(re.escape(x) for x in LEET if not x.isalnum())
_OUTER = re.compile(rf"^(?:_|[^\w{_MARKS}])+|(?:_|[^\w{_MARKS}])+$")
_PLAIN = re.compile(r"(?:[^\W\d_]+)(?:['’-][^\W\d_]+)*\Z")
_THRICE = re.compile(r"([^\W\d_])\1\1", re.IGNORECASE)
_LETTER = re.compile(r"[^\W\d_]")
#: Plain by its characters, but single letters with marks between them.
_LETTERED = re.compile(r"[^\W\d_](?:['’-][^\W\d_]){2,}\Z")
_ONE = rf"(?:[^\W_]|[{_MARKS}])"
_SPACED = re.compile(rf"(?<![^\s\"'“‘(\[{{]){_ONE}(?:[ ._*'~-]+{_ONE}){{2,}}(?=[.,;:!?\"'”’)\]}}…]*(?!\S))")
_SEPARATED = re.compile(r"[ ._*'~-]{2,}")


def _trigram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SIZE**3, np.int64)
    for batch in batches:
        for _, offsets, data in chunks(column(batch, "text")):
            c = _CLASSES[data]
            if len(c) < 3:
                continue
            codes = (c[:-2] * _SIZE + c[1:-1]) * _SIZE + c[2:]
            total += np.bincount(codes, minlength=len(total))
            edges = offsets[1:-1]
            over = np.unique(np.concatenate([edges - 1, edges - 2]))
            total -= np.bincount(codes[over[(over >= 0) & (over < len(codes))]], minlength=len(total))
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of a character class after two others, from every text of the corpus."""
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_trigram_rows, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full(_SIZE**3, 0.05)
    counts[rows.column("code").to_numpy()] += rows.column("n").to_numpy()
    table = counts.reshape(_SIZE, _SIZE, _SIZE)
    return np.log(table / table.sum(axis=2, keepdims=True))


def _in_long_run(text: str) -> list[bool]:
    """Whether each character stands in a run of three or more."""
    return [len(m[0]) > 2 for m in re.finditer(r"(.)\1*", text, re.DOTALL) for _ in m[0]]


class Restorer:
    """Likeliest readings of obfuscated units."""

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()

    def _classes(self, c: str) -> int:
        if c == " ":
            return 0
        if "a" <= c <= "z":
            return ord(c) - 96
        return 28 if ord(c) >= 128 else 27

    def read(self, unit: str) -> str:
        """Viterbi over the lattice of ``unit``; a state is the last two classes and the last letter."""
        unit = unit.lower()
        states: dict[tuple, tuple[float, tuple]] = {(0, 0, "", 0): (0.0, ())}
        for c, long in zip(unit + " ", _in_long_run(unit + " "), strict=True):
            edges: list[tuple[str, float]] = []
            if c in LEET:
                edges += [(x, SWAP) for x in LEET[c]]
            if c in SEPARATORS and c != " ":
                edges += [("", JOIN), (" ", JOIN)]
            elif c == " ":
                edges += [("", JOIN), (" ", 0.0)]
            else:
                edges.append((c, 0.0))
            after: dict[tuple, tuple[float, tuple]] = {}
            for (a, b, last, n), (score, path) in states.items():
                options = edges
                if c == last and n and long:
                    options = [*edges, ("", AGAIN)]
                for out, cost in options:
                    if out:
                        k = self._classes(out)
                        state, value, way = (b, k, c, 1), score + cost + self.model[a][b][k], (out, path)
                    else:
                        state, value, way = (a, b, last, n), score + cost, path
                    if state not in after or value > after[state][0]:
                        after[state] = (value, way)
            states = after
        best = max((x for s, x in states.items() if s[1] == 0), key=lambda x: x[0], default=(0.0, ()))
        out, path = [], best[1]
        while path:
            out.append(path[0])
            path = path[1]
        return "".join(reversed(out)).strip()

    def token(self, token: str) -> str:
        """Reading of a token between white space; one that has but one reading stays as it is."""
        core = _EDGES.sub("", token)
        if not _LETTER.search(core):
            return core
        return core.lower() if _plain(core) else self.read(core)

    def readings(self, token: str) -> list[str]:
        """Readings of a token without the symbols at its ends, and with those that may be letters; none if both are plain."""
        core, whole = _EDGES.sub("", token), _OUTER.sub("", token)
        out = [] if _plain(core) else [self.token(token)]
        if whole != core and _LETTER.search(whole):
            out.append(self.read(whole))
        return out

    def spaced(self, text: str) -> list[str]:
        """Readings of runs of three or more single characters with separators between them; closing marks may follow."""
        return [self.read(_SEPARATED.sub(lambda x: x[0][0], m[0])) for m in _SPACED.finditer(text) if _LETTER.search(m[0])]


def _plain(core: str) -> bool:
    """Whether a token without its edges has but one reading."""
    return bool(_PLAIN.match(core)) and not _THRICE.search(core) and not _LETTERED.match(core)


def _named(restored: str) -> set[str]:
    out = set()
    for w in _WORDS.findall(restored):
        out.add(w)
        out.update("^" + w[:k] for k in PREFIXES if len(w) > k)
    return out


def features(text: str, restorer: Restorer, known: dict[str, set[str]]) -> set[str]:
    """Words and word beginnings of the restored text; ``known`` remembers those of tokens."""
    tokens = set(text.split())
    if len(known) > REMEMBERED // 4:
        known.clear()
    for token in tokens.difference(known):
        known[token] = _named(token.lower()).union(*map(_named, restorer.readings(token)))
    out: set[str] = set().union(*map(known.__getitem__, tokens))
    for unit in restorer.spaced(text):
        out |= _named(unit)
    return out


def _toxic_rows(batches: Iterator[pa.RecordBatch], restorer: Restorer) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    known: dict[str, set[str]] = {}
    for batch in (part for whole in batches for part in _sliced(whole)):
        for text in column(batch, "text").to_pylist():
            total.update(features(text or "", restorer, known))
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["feature", "n"])


def _sample_rows(batches: Iterator[pa.RecordBatch], restorer: Restorer, number: dict[str, int]) -> Iterator[pa.RecordBatch]:
    known: dict[str, set[str]] = {}
    for batch in batches:
        found = [sorted({number[f] for f in features(t or "", restorer, known) if f in number}) for t in column(batch, "text").to_pylist()]
        yield pa.RecordBatch.from_arrays([column(batch, "toxic"), pa.array(found, pa.list_(pa.int32()))], names=["toxic", "found"])


def _fit(rows: list[list[int]], toxic: np.ndarray, n: int, block: int = 2000) -> np.ndarray:
    """Ridge logistic regression by Newton steps over blocks of rows; the last weight is the constant."""

    def blocks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(rows), block):
            x = np.zeros((min(block, len(rows) - at), n + 1))
            x[:, -1] = 1
            for i, row in enumerate(rows[at : at + block]):
                x[i, row] = 1
            yield x, toxic[at : at + block]

    w, ridge = np.zeros(n + 1), np.full(n + 1, RIDGE)
    ridge[-1] = 1e-3
    for _ in range(25):
        second, first = np.diag(ridge), -ridge * w
        for x, y in blocks():
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            second += (x * (p * (1 - p) + 1e-6)[:, None]).T @ x
            first += x.T @ (y - p)
        step = np.linalg.solve(second, first)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, restorer: Restorer, sample: int = SAMPLE) -> tuple[dict[str, float], float]:
    """Weights of features and the constant, from at most ``sample`` labelled rows that are not held out."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(restorer)
    known = labels.where(F.col("toxic").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).distinct()
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)  # at most 16 bytes x sample
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id").select("toxic", "text")
    counted = texts.where("toxic = 1").mapInArrow(lambda it: _toxic_rows(it, shared.value), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    top = [r.feature for r in counted.where(F.col("n") >= SUPPORT).orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect()]
    number = spark.sparkContext.broadcast({f: i for i, f in enumerate(top)})
    table = written(texts.mapInArrow(lambda it: _sample_rows(it, shared.value, number.value), "toxic int, found array<int>"), "op7-sample")
    size = {r.toxic: r.n for r in table.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return {}, 30.0 if toxic else -30.0
    per = table.select("toxic", F.explode("found").alias("f")).groupBy("f").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).toArrow()
    f, a, b = (per.column(x).to_numpy().astype(np.int64) for x in ("f", "a", "b"))
    share = (a + b) / (toxic + clean)
    z = (a / toxic - b / clean) / np.sqrt(share * (1 - share) * (1 / toxic + 1 / clean) + 1e-12)
    chosen = f[np.lexsort((f, -z))][: min(FEATURES, int((z > 4).sum()))]
    place = {int(x): i for i, x in enumerate(chosen)}
    if not place:
        return {}, float(np.log(toxic / clean))
    kept = table.select("toxic", F.array_intersect("found", F.array(*[F.lit(x) for x in place])).alias("found")).toArrow()
    w = _fit([[place[x] for x in r] for r in kept.column("found").to_pylist()], kept.column("toxic").to_numpy(), len(place))
    return {top[x]: float(w[i]) for x, i in place.items()}, float(w[-1])


def _scores(texts: Iterator[pa.Array], restorer: Restorer, weights: dict[str, float], constant: float) -> Iterator[pa.Array]:
    known: dict[str, frozenset[str]] = {}
    nothing: frozenset[str] = frozenset()

    def of(restored: str) -> frozenset[str]:
        return frozenset(f for f in _named(restored) if f in weights) or nothing

    for batch in texts:
        scores = []
        for at in range(0, len(batch), SLICE):
            for text in batch.slice(at, SLICE).to_pylist():
                text = text or ""
                tokens = set(text.split())
                for token in tokens.difference(known):
                    known[token] = of(token.lower()).union(*map(of, restorer.readings(token))) or nothing
                found: set[str] = set().union(*filter(None, map(known.__getitem__, tokens)))
                for unit in restorer.spaced(text):
                    found |= of(unit)
                total = constant + sum(weights[f] for f in sorted(found))
                scores.append(1 / (1 + exp(-max(-30.0, min(30.0, total)))))
                if len(known) > REMEMBERED:
                    known.clear()
        yield pa.array(scores, pa.float64())


def _sliced(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, rows) for i in range(0, len(batch), rows))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, carry: Sequence[str] = ()) -> DataFrame:
    """A score from 0 to 1 for the whole text of each document: how likely label 1 is.

    The character model is counted on all texts; the classifier is fitted on at most ``sample``
    labelled rows, none of them with crc32(doc_id as text) mod 4 = 2, which are held out. Gives
    doc_id and score, one row per document.

    Null and empty texts have the score of a text without features. A null id is never labelled.
    Rows that repeat an id are scored one by one. Labels that are null or neither 0 nor 1 teach
    nothing; repeated labels count once each value. Without toxic labels, or without clean ones,
    all scores are 0 or 1. An empty table gives an empty table; other columns are not read, but
    those that ``carry`` names come along, unless they have the name of a column given here.
    """
    spark = docs.sparkSession
    restorer = Restorer(character_model(docs))
    weights, constant = train(docs, labels, restorer, sample)
    shared = spark.sparkContext.broadcast((restorer, weights, constant))

    # Only texts go to the workers and only scores come back; what is carried stays where it is.
    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _scores(texts, *shared.value)

    others = [F.col(f"`{c}`") for c in carry if c.lower() not in ("doc_id", "score")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *others, score(F.col("text").cast("string")).alias("score"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
