"""How far the sources of a language differ in their words.

In-mapper stripes: every partition folds its whole documents into one hash
table of stripes, (language, term) -> document frequency and occurrences by
source. When the table holds ``CELLS`` counts it is spilled, as one row for each
stripe, and begun anew. Spilled stripes are merged by key; a stripe that is in
enough documents is kept whole.

Merged stripes emit the divergences: stripes and the sources' totals meet in
groups of (language, pair of source blocks, part of the terms), and each group
adds up ``abs(p_a - p_b)`` over its stripes for all pairs of its sources at
once. A term that none of a block's sources has is not sent there: its share is
the same for all such terms and is added from their number.

Probabilities are exact integers, ``1 + floor(10**9 * (count + 5) / (N + 5 * V))``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, scratch, shuffle_width, table

#: Documents of a language that a kept term is in, at least; smoothing count.
LEAST, SMOOTH = 30, 5
#: Most telling terms of a source that are reported.
TOP = 50
#: (term, source) counts that a partition holds before it spills them.
CELLS = 500_000
#: Sources of a block, and about how many stripes one group adds up.
BLOCK, STRIPES = 128, 4096
#: Terms of a group that are subtracted at once.
TERMS = 64

#: Bytes of a term: letters A-Z (made lower case) and a-z, and all non-ASCII.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8: maximal runs of ASCII letters
    and non-ASCII characters; only A-Z are made lower case."""
    return text.encode().translate(_FOLD).split(b" ")


_SPILLED = pa.schema([("lang", pa.string()), ("term", pa.string()), ("df", pa.int64()),
                      ("source", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])
_MERGED = pa.schema([("lang", pa.string()), ("term", pa.string()), ("total", pa.int64()),
                     ("source", pa.list_(pa.string())), ("n", pa.list_(pa.int64()))])


def _rows(schema: pa.Schema, lang: list[str], term: list, number: list[int], by: list[dict[str, int]]) -> pa.RecordBatch:
    """Stripes as a batch: each with the lists of its sources and their counts."""
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(b) for b in by])]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(values, kind)) for values, kind in (
        ([s for b in by for s in b], pa.string()), ([n for b in by for n in b.values()], pa.int64()))]
    return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(term, pa.binary()).cast(pa.string()),
                                       pa.array(number, pa.int64()), *lists], schema=schema)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (lang, source, text) -> stripes (lang, term, df, source, n)."""
    held: dict[str, dict[bytes, list]] = {}
    cells = 0

    def spill() -> Iterator[pa.RecordBatch]:
        for lang, own in held.items():
            items = iter(own.items())
            while part := list(islice(items, 20_000)):
                yield _rows(_SPILLED, [lang] * len(part), [t for t, _ in part], [s[0] for _, s in part], [s[1] for _, s in part])
        held.clear()
    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
            counts = Counter(terms(text))
            counts.pop(b"", None)
            own = held.setdefault(lang, {})
            for t, n in counts.items():
                stripe = own.get(t)
                if stripe is None:
                    own[t] = [1, {source: n}]
                    cells += 1
                else:
                    stripe[0] += 1
                    by = stripe[1]
                    if source in by:
                        by[source] += n
                    else:
                        by[source] = n
                        cells += 1
            if cells >= CELLS:
                yield from spill()
                cells = 0
    yield from spill()


def _merge(least: int):
    """Spilled stripes sorted by key -> the merged stripes of ``least`` documents or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, df, by = None, 0, {}  # the stripe that may go on in the next batch
        out: list[tuple] = []

        def done() -> pa.RecordBatch:
            rows = _rows(_MERGED, *(list(x) for x in zip(*out)))
            out.clear()
            return rows
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, term = batch.column("lang"), batch.column("term")
            new = np.ones(batch.num_rows, dtype=bool)
            new[1:] = ~(pc.equal(lang[1:], lang[:-1]).to_numpy(zero_copy_only=False)
                        & pc.equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False))
            start = np.flatnonzero(new)
            end = np.append(start[1:], batch.num_rows)
            size = np.add.reduceat(batch.column("df").to_numpy(), start)
            # Those of too few documents that lie inside the batch are passed over unread.
            look = size >= least
            look[[0, -1]] = True
            source, n = batch.column("source"), batch.column("n")
            for i in np.flatnonzero(look).tolist():
                a, b = int(start[i]), int(end[i])
                now = (lang[a].as_py(), term[a].as_py().encode())
                if now != key:
                    if df >= least:
                        out.append((key[0], key[1], sum(by.values()), by))
                    key, df, by = now, 0, {}
                df += int(size[i])
                for s, c in zip(source.slice(a, b - a).flatten().to_pylist(), n.slice(a, b - a).flatten().to_pylist()):
                    by[s] = by.get(s, 0) + c
            if len(out) >= 5000:
                yield done()
        if df >= least:
            out.append((key[0], key[1], sum(by.values()), by))
        if out:
            yield done()
    return run


def stripes(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term, total, source, n): for each term in at least ``least``
    documents of a language its occurrences, and those by source (two lists)."""
    spark = docs.sparkSession
    spilled = docs.select("lang", "source", "text").mapInArrow(
        _fold, "lang string, term string, df long, source array<string>, n array<long>")
    return (spilled.repartition(shuffle_width(spark), "lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(_merge(least), "lang string, term string, total long, source array<string>, n array<long>"))


def share(count, size, kept):
    """1 + floor(10**9 * (count + 5) / (size + 5 * kept)) of longs (or arrays
    of them), exact: a long division by thousands, so nothing overflows."""
    whole = size + SMOOTH * kept
    out, rest = np.divmod(np.asarray(count) + SMOOTH, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def _diverge(top: int):
    """One group of (language, source blocks x <= y, part): its stripes and the
    sources of both blocks -> rows (lang, a, b, term, value, n).

    With a term: source ``a`` has it more often than the language, by ``value``
    (only of blocks x = y, the ``top`` of this part). Without: the sum over the
    group's ``n`` stripes of the distance between sources ``a`` and ``b``.
    """
    columns = ["lang", "a", "b", "term", "value", "n"]

    def run(key: tuple, own: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        lang, x, y = key[:3]
        out = [(lang, None, None, None, 0, 0)][:0]
        if not len(own) or not len(sources):
            return pd.DataFrame(out, columns=columns)
        sources = sources.sort_values("number")
        names = sources["source"].tolist()
        at = {s: i for i, s in enumerate(names)}
        size = sources["size"].to_numpy(np.int64)
        kept, whole = int(sources["kept"].iloc[0]), int(sources["whole"].iloc[0])
        block = sources["block"].to_numpy()
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        empty = share(np.zeros(len(names), np.int64), size, kept)
        total = np.zeros((len(left), len(right)), dtype=np.int64)
        best: dict[int, list[tuple[int, str]]] = {}
        language = share(own["total"].to_numpy(np.int64), whole, kept)
        chosen, counts = own["source"].tolist(), own["n"].tolist()
        for low in range(0, len(own), TERMS):
            part = range(low, min(low + TERMS, len(own)))
            row = np.repeat(np.arange(len(part)), [len(chosen[t]) for t in part])
            which = np.array([at[s] for t in part for s in chosen[t]], dtype=np.int64)
            p = np.tile(empty, (len(part), 1))
            p[row, which] = share(np.concatenate([np.asarray(counts[t], dtype=np.int64) for t in part]), size[which], kept)
            total += np.abs(p[:, left, None] - p[:, None, right]).sum(axis=0)
            if x == y:
                over = p[row, which] - language[low + row]
                for j in np.flatnonzero(over > 0):
                    best.setdefault(int(which[j]), []).append((int(over[j]), own["term"].iat[low + row[j]]))
        for i, found in best.items():
            found.sort(key=lambda f: (-f[0], f[1].encode()))
            out += [(lang, names[i], None, term, value, 1) for value, term in found[:top]]
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                if a < b:
                    out.append((lang, names[a], names[b], None, int(total[i, j]), len(own)))
        return pd.DataFrame(out, columns=columns)
    return run


def source_divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(text, lang, source; others ignored) -> lang, source, part, item, value, rank.

    Each language keeps the terms that ``least`` of its documents hold. Every
    (language, source) that occurs is a group, also without any term. Part
    ``pair``: every other source of the language and the sum, over all kept
    terms, of the distance between both groups' shares (0 where none is kept).
    Part ``term``: the kept terms that a group has, and has more often than the
    language, with the difference of the shares; the ``top`` first. Ranks are by
    value, descending, ties by the item's UTF-8 bytes.

    NULL text, language and source are read as ''. Repeated rows count as often
    as they occur. No documents give no rows, a language's only source no pairs.
    """
    spark = docs.sparkSession
    clean = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    with scratch(spark):
        kept = materialise(stripes(clean, least), "stripes")
        occurring = clean.select("lang", "source").distinct()
        cells = kept.select("lang", F.explode(F.arrays_zip("source", "n")).alias("c")).select("lang", "c.source", "c.n")
        sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("size"))
        langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("whole"))
        # Sources get consecutive numbers within their language, in byte order.
        number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        sources = materialise(
            occurring.join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").withColumn("number", number)
            .select("lang", "source", "number", F.expr(f"number div {BLOCK}").cast("int").alias("block"),
                    *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("size", "kept", "whole"))), "sources")
        blocks = sources.groupBy("lang").agg(
            (F.max("block") + 1).alias("blocks"),
            F.ceil(F.max("kept") / F.lit(float(STRIPES))).cast("int").alias("parts"))
        found = materialise(_groups(kept, sources, blocks, top), "divergences")
        pairs = materialise(_pairs(sources, found), "divergence-pairs", lasting=True)
        strange = materialise(found.where("term IS NOT NULL").select(
            "lang", F.col("a").alias("source"), F.col("term").alias("item"), "value"), "divergence-terms", lasting=True)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(strange, "term").where(F.col("rank") <= top))


def _groups(kept: DataFrame, sources: DataFrame, blocks: DataFrame, top: int) -> DataFrame:
    """Deal stripes and sources into the groups of ``_diverge``."""
    place = sources.select("lang", "source", "block")
    # A stripe's counts by block of its sources; with one block that is the stripe.
    cut = (kept.select("lang", "term", "total", F.explode(F.arrays_zip("source", "n")).alias("c"))
           .select("lang", "term", "total", "c.source", "c.n").join(place, ["lang", "source"])
           .groupBy("lang", "term", "total").agg(F.collect_list(F.struct("block", "source", "n")).alias("held"))
           .join(blocks, "lang"))
    own = F.array_distinct(F.transform("held", lambda h: h["block"]))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    pair = F.array_distinct(F.flatten(F.transform(own, lambda b: F.transform(
        other, lambda o: F.struct(F.least(b, o).alias("x"), F.greatest(b, o).alias("y"))))))
    part = F.pmod(F.xxhash64("term"), F.col("parts").cast("long")).cast("int")
    sent = (cut.withColumn("part", part).select("lang", "term", "total", "part", "held", F.explode(pair).alias("p"))
            .select("lang", "p.x", "p.y", "part", "term", "total",
                    F.filter("held", lambda h: (h["block"] == F.col("p.x")) | (h["block"] == F.col("p.y"))).alias("held"))
            .select("lang", "x", "y", "part", "term", "total", F.col("held.source").alias("source"), F.col("held.n").alias("n")))
    at = sources.join(blocks, "lang").where("parts > 0")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least("block", o).alias("x"), F.greatest("block", o).alias("y")))
    dealt = (at.withColumn("p", F.explode(pairs)).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("lang", "p.x", "p.y", "part", "source", "number", "block", "size", "kept", "whole"))
    key = ["lang", "x", "y", "part"]
    run = _diverge(top)

    def both(key_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return run(key_, left, right)
    return (sent.groupBy(*key).cogroup(dealt.groupBy(*key))
            .applyInPandas(both, "lang string, a string, b string, term string, value long, n long"))


def _pairs(sources: DataFrame, found: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of a language's sources."""
    summed = found.where("term IS NULL").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    facts = sources.select("lang", "source", "number", "size", "kept")
    # The result has a row for each pair of sources of a language: so has this join.
    a, b = facts.alias("a"), facts.alias("b")
    whole = a.join(b, (F.col("a.lang") == F.col("b.lang")) & (F.col("a.number") < F.col("b.number"))).select(
        F.col("a.lang").alias("lang"), F.col("a.source").alias("a"), F.col("b.source").alias("b"), F.col("a.kept").alias("kept"),
        F.col("a.size").alias("size_a"), F.col("b.size").alias("size_b"))

    def empty(size: str):
        return F.expr(f"CASE WHEN kept > 0 THEN 1 + {SMOOTH}000000000 div ({size} + {SMOOTH} * kept) ELSE 0 END")
    rest = (F.col("kept") - F.coalesce("n", F.lit(0))) * F.abs(empty("size_a") - empty("size_b"))
    total = whole.join(summed, ["lang", "a", "b"], "left").select(
        "lang", "a", "b", (F.coalesce("value", F.lit(0)) + rest).cast("long").alias("value"))
    return (total.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p"), "value")
            .select("lang", "p.source", "p.item", "value"))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """The sources of all ``documents``: pairs and telling terms, by language."""
    return source_divergence(table(spark, sf_dir, "documents"))


ORACLE_OP13 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents
), w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= {LEAST}
), c AS (
  SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL
), v AS (
  SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN k USING (lang) GROUP BY ALL
), g AS (
  SELECT s.lang, s.source, coalesce(sum(c.n), 0)::HUGEINT AS size
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + {SMOOTH})::HUGEINT) // (g.size + {SMOOTH} * v.v) AS p
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), q AS (
  SELECT l.lang, l.term, 1 + (1000000000 * (l.n + {SMOOTH})::HUGEINT) // (s.size + {SMOOTH} * v.v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL) l
  JOIN (SELECT lang, sum(size) AS size FROM g GROUP BY ALL) s USING (lang) JOIN v USING (lang)
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source AS sa, y.source AS sb, sum(abs(x.p - y.p)) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
    ON f.lang = a.lang AND f.sa = a.source AND f.sb = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT * FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM r
) WHERE part = 'pair' OR rank <= {TOP}
"""
