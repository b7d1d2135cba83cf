"""Personal data: what its form gives away, and what its context does.

1. Base. Addresses, numbers and cards of a standard form are found by their
   form alone (``base_spans``). They are the seeds, with score 1 for their kind.
2. Instances. Besides the seeds, every token that could be an identifier
   (``_tokens``) is an instance without a kind. All instances stand in lexical
   patterns: the two or three words before it, the two behind it, and the word
   on either side. Numbers in a pattern read ``#``.
3. Graph. Patterns and instances are the two sides of a graph, an edge where an
   instance occurs in a pattern, however often. In each round Spark scores both:

       confidence(pattern, kind) = sum of its instances' scores / (instances + 1)
       score(instance, kind)     = 1 - product over its patterns of (1 - confidence)

   A pattern counts from ``CONFIDENT`` and a score mass of ``SUPPORT`` on; an
   instance is accepted for its best kind from ``ACCEPT`` and two such patterns
   on, if it has as many digits as the kind's seeds do and letters where most of
   those have them. Accepted instances support further patterns in the next
   round, until a round accepts nothing new.
4. An accepted identifier is reported wherever it stands, not only where a
   pattern found it.

Edges are counted once for each pair, so copies of a text, and a number that
stands in a third of all texts, weigh no more than one. Nothing but four rows,
the kinds' profiles, comes to the driver.
"""

from __future__ import annotations

import functools
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, scratch, table

KINDS = ("email", "ip", "card", "phone")
CONFIDENT, SUPPORT, ACCEPT, PATTERNS, ROUNDS = 0.8, 4.0, 0.9, 2, 4
#: Code points of an unseen identifier, and digits of one without an at sign.
SHORTEST, LONGEST, DIGITS = 5, 64, 4
#: Code points on either side that words of a pattern come from.
REACH = 100

# The base forms. Each is matched without rescanning a run.
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_TOKEN = re.compile(r"(?<!\S)(?:[^\s0-9@]*+[0-9@]\S*+|\S*?(?:\(at\)|\[at\])\S*+)")
_WORD = re.compile(r"\w+")
_DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    """Whether the last of the digits is the check digit of those before it."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, sorted; ``kind`` is a place in KINDS.

    Of each kind the leftmost matches that do not overlap; those that fail
    their check (parts over 255, number of digits, Luhn) are dropped."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _tokens(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Tokens that may be identifiers and touch no base span.

    A token is what stands between white space, without marks at its edges;
    neighbours of digits and marks only, with one blank between, are one."""
    runs: list[list] = []
    for m in _TOKEN.finditer(text):
        plain = not any(c.isalpha() or c == "@" for c in m.group())
        if runs and plain and runs[-1][2] and text[runs[-1][1]:m.start()] == " ":
            runs[-1][1] = m.end()
        else:
            runs.append([m.start(), m.end(), plain])
    starts, ends = [], []  # the base spans' union
    for a, _, b in base:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for a, b, _ in runs:
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        own = text[a:b]
        if "@" not in own and "(at)" not in own and "[at]" not in own and len(_DIGIT.findall(own)) < DIGITS:
            continue
        if not SHORTEST <= b - a <= LONGEST:
            continue
        i = bisect_right(ends, a)
        if i < len(ends) and starts[i] < b:
            continue
        yield a, b


def _patterns(text: str, start: int, end: int) -> list[str]:
    def words(part: str) -> list[str]:
        return ["#" if _DIGIT.search(w) else w.lower() for w in _WORD.findall(part)]
    before = words(text[max(0, start - REACH):start])[-3:]
    after = words(text[end:end + REACH])[:2]
    out = []
    if len(before) > 1:
        out.append(f"{before[-2]} {before[-1]} _")
    if len(before) > 2:
        out.append(f"{' '.join(before)} _")
    if len(after) > 1:
        out.append(f"_ {after[0]} {after[1]}")
    if before and after:
        out.append(f"{before[-1]} _ {after[0]}")
    return out


def _instances(text: str) -> list[dict]:
    base = base_spans(text)
    out = []
    for a, kind, b in [*base, *((a, -1, b) for a, b in _tokens(text, base))]:
        own = text[a:b].lower()
        name = int.from_bytes(hashlib.blake2b(own.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)
        out.append({"start": a, "kind": kind, "end": b, "instance": name, "digits": len(_DIGIT.findall(own)),
                    "letters": any(c.isalpha() for c in own), "patterns": _patterns(text, a, b)})
    return out


_FOUND = ("array<struct<start:int,kind:int,end:int,instance:long,digits:int,letters:boolean,patterns:array<string>>>")


def _read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        yield pd.DataFrame({"row": pdf["row"], "doc_id": pdf["doc_id"],
                            "found": [_instances(t) if t else [] for t in pdf["text"]]})


def _profiles(edges: DataFrame) -> list:
    """Fewest and most digits of each kind's seeds, and whether most have letters."""
    return (edges.where("kind >= 0").groupBy("kind")
            .agg(F.min("digits").alias("least"), F.max("digits").alias("most"),
                 (F.avg(F.col("letters").cast("int")) >= 0.5).alias("letters")).collect())  # a row a kind


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, instance, kind (-1: none yet), digits, letters), different rows
    -> the accepted (instance, kind, score) and the patterns (pattern, kind, confidence) that found them."""
    spark = edges.sparkSession
    support = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("instances")).where(
        F.col("instances") >= SUPPORT)
    # A pattern of fewer instances can never count.
    edges = materialise(edges.join(support, "pattern"), "pii-edges")
    seeds = materialise(edges.where("kind >= 0").select("instance", "kind").distinct()
                        .withColumn("score", F.lit(1.0)), "pii-seeds")
    profiles = _profiles(edges)
    fits = functools.reduce(Column.__or__, (
        (F.col("k") == p["kind"]) & F.col("digits").between(p["least"], p["most"]) & (F.col("letters") == p["letters"])
        for p in profiles), F.lit(False))
    accepted = spark.createDataFrame([], "instance long, kind int, score double")
    good = spark.createDataFrame([], "pattern string, kind int, confidence double")
    n = -1
    sides = edges.select("pattern", "instance", "instances").distinct()
    for _ in range(rounds):
        known = seeds.unionByName(accepted)
        good = materialise(
            sides.join(known, "instance").groupBy("pattern", "kind", "instances").agg(F.sum("score").alias("mass"))
            .where(F.col("mass") >= SUPPORT)
            .select("pattern", "kind", F.round(F.col("mass") / (F.col("instances") + 1), 9).alias("confidence"))
            .where(F.col("confidence") >= CONFIDENT), "pii-patterns")
        scored = (edges.where("kind < 0").drop("kind").join(good.withColumnRenamed("kind", "k"), "pattern").where(fits)
                  .groupBy("instance", "k").agg(
                      F.round(1 - F.exp(F.sum(F.log(1 - F.col("confidence")))), 9).alias("score"), F.count("*").alias("n"))
                  .where((F.col("n") >= PATTERNS) & (F.col("score") >= ACCEPT)))
        best = F.max_by(F.struct("k", "score"), F.struct("score", -F.col("k"))).alias("b")
        accepted = materialise(scored.groupBy("instance").agg(best).select(
            "instance", F.col("b.k").alias("kind"), F.col("b.score").alias("score")), "pii-accepted")
        before, n = n, accepted.count()
        if n in (0, before):
            break
    return accepted, good


def personal_data(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text; others ignored) -> doc_id, base and spans, for each row.

    ``base`` and ``spans`` are arrays of (start, kind, end), sorted, in code
    points, end exclusive; ``kind`` is a place in KINDS. ``spans`` holds base
    and what the contexts found. A NULL or empty text has none. Rows with a
    NULL or repeated doc_id are rows like any other; no rows give no rows.
    """
    spark = docs.sparkSession
    with scratch(spark):
        read = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                           "text").mapInPandas(_read, f"row long, doc_id long, found {_FOUND}")
        read = materialise(read, "pii-instances", lasting=True)
        each = read.where(F.size("found") > 0).select("row", F.explode("found").alias("f")).select("row", "f.*")
        edges = each.select(F.explode("patterns").alias("pattern"), "instance", "kind", "digits", "letters").distinct()
        accepted, _ = bootstrap(edges, rounds)
        unseen = each.where("kind < 0").select("row", "instance", "start", "end")
        added = (unseen.join(accepted.select("instance", "kind"), "instance")
                 .groupBy("row").agg(F.collect_list(F.struct("start", "kind", "end")).alias("added")))
        added = materialise(added, "pii-added", lasting=True)
    base = F.transform(F.filter("found", lambda f: f["kind"] >= 0), lambda f: F.struct(
        f["start"].alias("start"), f["kind"].alias("kind"), f["end"].alias("end")))
    return (read.select("row", "doc_id", base.alias("base")).join(added, "row", "left")
            .select("doc_id", "base", F.array_sort(F.when(F.col("added").isNull(), F.col("base"))
                                                   .otherwise(F.concat("base", "added"))).alias("spans")))


def spelt(spans: str) -> Column:
    """An array of (start, kind, end) as ``kind:start:end`` joined by commas."""
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op12_contextual_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every text of ``documents``."""
    found = personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")
    return found.select("doc_id", *(count(k) for k in range(len(KINDS))),
                        F.sha2(spelt("base"), 256).alias("base_sha256"), spelt("spans").alias("spans"))
