"""Secrets in texts: known forms, and strings that pass a battery of randomness tests.

All of it is expressions of Spark; no row leaves the JVM and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame, functions as F

# The known forms, by kind, with the characters that the group (0: all of it) needs.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
KINDS = [kind for kind, *_ in BASE] + ["random"]
#: Share of false findings among a text's candidates, and the limit of the joint statistic of three
#: tests (chi-squared, three degrees of freedom, one in a thousand) beyond which a string is not random.
FALSE_SHARE, NOT_RANDOM = 0.01, 16.27
#: The battery takes strings whose length tells random from ordinary text in their encoding: so many standard
#: deviations lie between the two (a typical random string then has p = 0.0002). Every encoding has that from 20 characters on.
LEAST_FAR = 3.6
# Inferred encodings: pattern, symbols, chance that two random neighbours differ in class, and how
# ordinary text of the same characters differs: concentration of symbols and changes of class.
ENCODINGS = (
    (r"^[0-9]+$", 10, 0.5, 1.0, 0.5),
    (r"^([0-9a-f]+|[0-9A-F]+)$", 16, 0.469, 2.0, 0.2),
    (r"^([a-z]+|[A-Z]+)$", 26, 0.31, 1.8, 0.65),
    (r"^([A-Z2-7]+|[a-z2-7]+)=*$", 32, 0.305, 2.2, 0.1),
    (r"^([A-Z0-9]+|[a-z0-9]+)$", 36, 0.401, 2.2, 0.1),
    (r"^[A-Za-z]+$", 52, 0.5, 2.7, 0.3),
    (r"^[A-Za-z0-9]+$", 62, 0.622, 3.0, 0.3),
    (r"^[A-Za-z0-9+/_-]+=*$", 64, 0.64, 3.4, 0.25),
)
DIGITS, LETTERS = 0, 2


def _apart(n: float, symbols: float, change: float, heavy: float, usual: float) -> float:
    """Standard deviations between random strings of n characters and ordinary text."""
    return sqrt((n * (heavy - 1)) ** 2 / (2 * (symbols - 1)) + n * (usual - change) ** 2 / (change * (1 - change)))


#: Characters that an encoding needs for the battery, and what is looked at: runs of as many as one of them needs.
LEAST = [next((n for n in range(2, 1000) if _apart(n, *row[1:]) >= LEAST_FAR), 1000) for row in ENCODINGS]
CANDIDATE = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{min(LEAST)},}}+={{0,2}}"


def _places(text: Column, pattern: str, group: int, least: int) -> Column:
    """(first, end, found) of the matches of a pattern, in code points, whose group is long enough.

    The parts between the matches give the places: nothing else in Spark tells where a match is.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    kept = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<first:int,end:int,found:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(state: Column, part: Column) -> Column:
        first = state["at"] + F.length(part["gap"])
        end = first + F.length(part["all"])
        one = F.struct(first.alias("first"), end.alias("end"), part["all"].alias("found"))
        return F.struct(end.alias("at"), F.when(F.length(part["kept"]) >= least, F.concat(state["out"], F.array(one))).otherwise(state["out"]).alias("out"))

    parts = F.filter(F.arrays_zip(between.alias("gap"), found.alias("all"), kept.alias("kept")), lambda p: p["all"].isNotNull())
    return F.when(text.rlike(pattern), F.aggregate(parts, start, step, lambda s: s["out"])).otherwise(empty)


def _of_kind(kind: int) -> Callable[[Column], Column]:
    return lambda x: F.struct(x["first"].alias("first"), F.lit(kind).alias("kind"), x["end"].alias("end"))


def _normal(x: Column) -> Column:
    """Share of the normal distribution below x."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(1.5976) * x + F.lit(0.07056) * x * x * x)))


def _encoding(token: Column) -> Column:
    """Place in ``ENCODINGS`` of the first one that has the token's characters."""
    out = F.lit(len(ENCODINGS) - 1)
    for k in reversed(range(len(ENCODINGS) - 1)):
        out = F.when(token.rlike(ENCODINGS[k][0]), F.lit(k)).otherwise(out)
    return out


def _tested(token: Column, encoding: Column) -> Column:
    """p (chance that ordinary text looks as random as the token) and joint (how far it is from random)."""
    body = F.rtrim(token, F.lit("="))
    codes = F.transform(F.split(body, ""), lambda c: F.ascii(c))
    n = F.length(body).cast("double")

    def pick(at: int) -> Column:
        return F.get(F.array(*[F.lit(float(row[at])) for row in ENCODINGS]), encoding)

    symbols, change, heavy, usual = (pick(i) for i in (1, 2, 3, 4))

    def kind(c: Column) -> Column:  # vowel or not for words; digit, small, capital or other letter
        vowel = F.lower(F.char(c)).isin("a", "e", "i", "o", "u").cast("int")
        digit = F.when(c.between(48, 57), 0).when(c.between(97, 122), 1).when(c.between(65, 90), 2).otherwise(3)
        return F.when(encoding == LETTERS, vowel).otherwise(digit)

    measured = F.struct(codes.alias("c"), n.alias("n"), symbols.alias("a"), change.alias("p"), heavy.alias("h"), usual.alias("u"))

    def battery(m: Column) -> Column:
        c, n, a, p = m["c"], m["n"], m["a"], m["p"]
        next_c = F.slice(c, 2, F.size(c) - 1)
        sizes = F.transform(F.array_distinct(c), lambda x: F.size(F.filter(c, lambda y: y == x)))
        squares = F.aggregate(sizes, F.lit(0.0), lambda s, k: s + k.cast("double") * k)
        z_chi = (a / n * squares - n - (a - 1)) / F.sqrt(F.lit(2.0) * (a - 1))
        pairs = F.filter(F.arrays_zip(c.alias("x"), next_c.alias("y")), lambda q: q["y"].isNotNull())
        changes = F.size(F.filter(pairs, lambda q: kind(q["x"]) != kind(q["y"]))).cast("double")
        z_runs = (changes - (n - 1) * p) / F.sqrt((n - 1) * p * (F.lit(1.0) - p))
        mean = F.aggregate(c, F.lit(0.0), lambda s, x: s + x) / n
        spread = F.aggregate(c, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
        lag = F.aggregate(pairs, F.lit(0.0), lambda s, q: s + (q["x"] - mean) * (q["y"] - mean))
        z_lag = F.when(spread > 0, lag / spread * F.sqrt(n)).otherwise(F.sqrt(n))
        up = F.greatest(z_chi, F.lit(0.0))
        text_chi = n * (m["h"] - 1) / F.sqrt(F.lit(2.0) * (a - 1))
        text_runs = F.sqrt(n) * (m["u"] - p) / F.sqrt(p * (F.lit(1.0) - p))
        far = F.sqrt(text_chi * text_chi + text_runs * text_runs)
        toward = F.when(far > 0, (z_chi * text_chi + z_runs * text_runs) / far).otherwise(F.lit(0.0))
        return F.struct(_normal(toward - far).alias("p"), (up * up + z_runs * z_runs + z_lag * z_lag).alias("joint"))

    return F.transform(F.array(measured), battery)[0]


def find_secrets(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text and ``spans`` (kind, first, end) of each document, by place and then kind.

    Places are code points, the end exclusive. The known forms are assignments to names such as
    password, access key ids and hexadecimal strings, leftmost matches that do not overlap within
    a kind. Other strings are ``random`` if symbols, changes of class and neighbours are as
    in a random string of the encoding that their characters allow, and if ordinary text would look
    so too seldom: the Benjamini-Hochberg rule over the text's candidates, whose chances shrink
    with length, holds the share of false findings. How long a string must be for that follows from
    its encoding (``LEAST``), 20 characters at most. Random spans do not overlap those of known forms;
    strings of digits alone are never random spans.

    Null and empty texts have no span; null ids stay; repeated rows are searched one by one; an
    empty table gives an empty table; other columns are not read, but those that ``carry`` names
    come along.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carry, F.col("text").cast("string").alias("text"), text.alias("whole"))
    out = out.select("doc_id", *carry, "text", *[_places(F.col("whole"), pattern, group, least).alias(kind) for kind, pattern, group, least in BASE], _places(F.col("whole"), CANDIDATE, 0, min(LEAST)).alias("candidates"))
    known = F.concat(*[F.transform(kind, _of_kind(k)) for k, (kind, *_) in enumerate(BASE)])
    out = out.select("doc_id", *carry, "text", F.array_sort(known).alias("known"), "candidates")
    free = F.filter("candidates", lambda x: ~F.exists("known", lambda k: (k["first"] < x["end"]) & (x["first"] < k["end"])))
    named = F.transform(free, lambda x: F.struct(x["first"].alias("first"), x["end"].alias("end"), x["found"].alias("found"), _encoding(x["found"]).alias("k")))
    least = F.array(*[F.lit(n) for n in LEAST])
    long_enough = F.filter(named, lambda x: (x["k"] != DIGITS) & (F.length(F.rtrim(x["found"], F.lit("="))) >= F.get(least, x["k"])))
    out = out.withColumn("candidates", F.when(F.size("candidates") > 0, long_enough).otherwise(F.array().cast("array<struct<first:int,end:int,found:string,k:int>>")))
    tested = F.transform("candidates", lambda x: F.struct(_tested(x["found"], x["k"]).alias("t"), x["first"].alias("first"), x["end"].alias("end")))
    ranked = F.array_sort(F.transform(tested, lambda x: F.struct(x["t"]["p"].alias("p"), x["t"]["joint"].alias("joint"), x["first"].alias("first"), x["end"].alias("end"))))
    out = out.withColumn("ranked", F.when(F.size("candidates") > 0, ranked))
    passed = F.transform("ranked", lambda x, i: F.when(x["p"] <= F.lit(FALSE_SHARE) * (i + 1) / F.size("ranked"), i + 1).otherwise(0))
    out = out.withColumn("cut", F.coalesce(F.array_max(passed), F.lit(0)))
    random = F.filter(F.slice("ranked", F.lit(1), F.col("cut")), lambda x: x["joint"] <= NOT_RANDOM)
    random = F.transform(random, _of_kind(len(BASE)))
    spans = F.when(F.col("cut") > 0, F.array_sort(F.concat("known", random))).otherwise(F.col("known"))
    names = F.array(*[F.lit(k) for k in KINDS])
    return out.select("doc_id", *carry, "text", F.transform(spans, lambda x: F.struct(names[x["kind"]].alias("kind"), x["first"].alias("first"), x["end"].alias("end"))).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with ``mark`` in place of each span; spans that overlap become one."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, x["first"] - state["at"])
        out = F.when(x["first"] >= state["at"], F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), out.alias("out"))

    done = F.aggregate(spans, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def op9_secret_scans(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["first"].cast("string"), x["end"].cast("string"))), ",")

    kinds = F.transform("spans", lambda x: x["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind, *_ in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(F.filter("spans", lambda x: x["kind"] != "random")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
