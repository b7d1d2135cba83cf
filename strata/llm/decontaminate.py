"""Benchmark decontamination: MinHash containment search, partitioned by size.

A test item is found in a document when at least ``THRESHOLD`` of its distinct
5-word shingles are among the document's. Comparing the MinHash of an item
with that of a much longer document finds nothing, as their Jaccard similarity
is near zero, so both are partitioned by size:

- Items fall into size classes: class ``c`` holds those of over ``2**(c-1)`` up
  to ``2**c`` shingles.
- For a class of up to ``u`` shingles, a document is covered by windows of
  three steps of ``u/2`` shingles, one window a step. Any run of ``u`` shingles
  lies within one window. So an item contained in a run of that length has at
  least the Jaccard similarity ``t*q / (window + (1-t)*q)`` with the window,
  whatever the document's length; the number of bands and rows follows from
  that bound and the wanted recall.

Window minima come from step minima, so all classes share one hashing of the
text. Minima that may equal an item's (a bitmap of bounded size tells) are
joined with the items'; each pair found is verified on full shingle sets.

An item of under five words is one shingle of all its words. With ``inside`` it is
a class of its own length ``k``, and the documents' shingles of ``k`` words are
compared with it, so it is found wherever its words stand in a row. Without,
only a text of just those words holds it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bits
from .common import materialise, scratch, table, text_key
from .text import chunks, mix64, shingle_hashes, word_hashes

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.9995


def size_class(n: int) -> int:
    return max(0, (n - 1).bit_length())


def layout(size: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int, int]:
    """(step, bands, rows) of a size class: the banding of fewest hash functions
    that reaches the wanted recall at the class's least Jaccard similarity."""
    most = 1 << size
    least = most // 2 + 1 if size else 1
    step = max(1, most // 2)
    least_jaccard = threshold * least / (3 * step + (1 - threshold) * least)
    best = None
    for rows in range(1, 5):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - least_jaccard ** rows))
        if best is None or bands * rows < best[1] * best[2]:
            best = (step, bands, rows)
    return best


def _keys(minima: np.ndarray, size: int, bands: int, rows: int) -> np.ndarray:
    """(bands, n) band keys from (bands * rows, n) minima."""
    out = np.empty((bands, minima.shape[1]), dtype=np.uint64)
    for b in range(bands):
        h = np.uint64(mix64(np.array([size * 1000 + b], dtype=np.uint64))[0])
        own = np.full(minima.shape[1], h, dtype=np.uint64)
        for r in range(rows):
            own = (own ^ minima[b * rows + r]) * np.uint64(0x9E3779B97F4A7C15)
            own ^= own >> np.uint64(29)
        out[b] = own
    return out


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64) + np.uint64(1 << 40))
    return seeds[::2] | np.uint64(1), seeds[1::2]


def _short_keys(hashes: np.ndarray) -> np.ndarray:
    """The key of an item that is one shingle."""
    return mix64(hashes ^ np.uint64(0x5851F42D4C957F2D))


def _item_signatures(n: int, threshold: float, recall: float, inside: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts):
                own = [t or "" for t in texts[a:b]]
                hashes, offsets = shingle_hashes(own, n)
                n_words = np.diff(word_hashes(own)[1])
                rows = []
                for i in range(b - a):
                    all_ = hashes[offsets[i]:offsets[i + 1]]
                    if not len(all_):
                        continue
                    if inside and n_words[i] < n:
                        rows.append((pdf["uid"].iloc[a + i], pdf["item_id"].iloc[a + i], -int(n_words[i]),
                                     all_.view(np.int64), _short_keys(all_).view(np.int64)))
                        continue
                    size = size_class(len(all_))
                    _, bands, r = layout(size, threshold, recall)
                    multiply, add = _functions(bands * r)
                    minima = (all_[None, :] * multiply[:, None] + add[:, None]).min(axis=1)
                    keys = _keys(minima[:, None], size, bands, r)[:, 0]
                    rows.append((pdf["uid"].iloc[a + i], pdf["item_id"].iloc[a + i], size,
                                 np.unique(all_).view(np.int64), keys.view(np.int64)))
                yield pd.DataFrame(rows, columns=["uid", "item_id", "size", "grams", "keys"])
    return run


def _search(n: int, sizes: list[int], threshold: float, recall: float, shared):
    """Documents' rows -> those with a band key or shingle that may be an item's."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key_bits, gram_bits = (np.frombuffer(x, np.uint8) for x in shared.value)
        plans = {s: layout(s, threshold, recall) for s in sizes if s >= 0}
        short = [-s for s in sizes if s < 0]
        multiply, add = _functions(max((b * r for _, b, r in plans.values()), default=0))
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts, 200_000):
                hashes, offsets = shingle_hashes([t or "" for t in texts[a:b]], n)
                found: dict[int, list] = {}
                lengths = np.diff(offsets)
                for size, (step, bands, rows) in plans.items():
                    steps = -(-lengths // step)
                    first = np.concatenate([[0], np.cumsum(steps)])
                    if not first[-1]:
                        continue
                    owner = np.repeat(np.arange(b - a), steps)
                    starts = offsets[owner] + (np.arange(first[-1]) - first[owner]) * step
                    left = first[owner + 1] - np.arange(first[-1])  # steps to the end of the text
                    minima = np.empty((bands * rows, len(starts)), dtype=np.uint64)
                    for i in range(bands * rows):
                        h = hashes * multiply[i]
                        h += add[i]
                        m = np.minimum.reduceat(h, starts)
                        two = np.where(left[:-1] > 1, np.minimum(m[:-1], m[1:]), m[:-1])
                        two = np.concatenate([two, m[-1:]])
                        three = two.copy()
                        three[:-2] = np.where(left[:-2] > 2, np.minimum(two[:-2], m[2:]), two[:-2])
                        minima[i] = three
                    for own in _keys(minima, size, bands, rows):
                        fresh = np.concatenate([[True], (own[1:] != own[:-1]) | (owner[1:] != owner[:-1])])
                        at = np.flatnonzero(fresh)
                        at = at[bits.contains(key_bits, own[at])]
                        for j in at:
                            found.setdefault(int(owner[j]), []).append(own[j])
                held: dict[int, list] = {}
                for k in short:
                    own, first = shingle_hashes([t or "" for t in texts[a:b]], k)
                    at = np.flatnonzero(bits.contains(gram_bits, own))
                    at = at[bits.contains(key_bits, _short_keys(own[at]))]
                    owner = np.searchsorted(first, at, side="right") - 1
                    for i in np.unique(owner):
                        grams = np.unique(own[at[owner == i]])
                        held.setdefault(int(i), []).append(grams)
                        found.setdefault(int(i), []).extend(_short_keys(grams))
                if found:
                    which = sorted(found)
                    out = pdf.iloc[[a + i for i in which]].drop(columns="text")
                    keys = [np.unique(np.array(found[i], dtype=np.uint64)).view(np.int64) for i in which]
                    grams = []
                    for i in which:
                        own = np.unique(hashes[offsets[i]:offsets[i + 1]])
                        own = own[bits.contains(gram_bits, own)]
                        grams.append(np.unique(np.concatenate([own, *held.get(i, [])])).view(np.int64))
                    yield out.assign(keys=keys, grams=grams)
    return run


def find_items(docs: DataFrame, items: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD,
               recall: float = RECALL, inside: bool = False) -> DataFrame:
    """Test items (item_id, text) contained in documents (doc_id, text).

    One row per document row and item row found: doc_id, item_id, n_shared,
    n_item (distinct shingles of the item), containment; plus h1, h2 (identity
    of the document's text). Other columns are ignored. NULL, empty or
    wordless texts and items are never found; an item of under five words is
    one shingle of all its words, which only a text of just those words holds, or
    with ``inside`` any text in which they stand in a row. Rows
    with a NULL id are judged as any other; repeated rows each give rows. No
    items or no documents give no rows.
    """
    spark = docs.sparkSession
    items = (items.select(F.col("item_id").cast("long").alias("item_id"), "text")
             .select("item_id", "text", F.monotonically_increasing_id().alias("uid"))
             .mapInPandas(_item_signatures(n, threshold, recall, inside),
                          "uid long, item_id long, size int, grams array<long>, keys array<long>"))
    items = materialise(items, "benchmark-items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # a class per power of two
    item_keys = items.select(F.col("uid").alias("item"), F.explode("keys").alias("key"))
    shared = spark.sparkContext.broadcast((
        bits.build(item_keys.select("key")).tobytes(),
        bits.build(items.select(F.explode("grams").alias("gram"))).tobytes()))
    h1, h2 = text_key(F.col("text"))
    hits = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), h1.alias("h1"), h2.alias("h2"),
                        F.monotonically_increasing_id().alias("doc"))
            .mapInPandas(_search(n, sizes, threshold, recall, shared),
                         "doc_id long, h1 long, h2 long, doc long, keys array<long>, grams array<long>"))
    hits = materialise(hits, "benchmark-hits")
    pairs = (hits.select("doc", F.explode("keys").alias("key")).join(item_keys, "key")
             .select("doc", "item").distinct())
    verified = (pairs.join(hits.select("doc", "doc_id", "h1", "h2", F.col("grams").alias("held")), "doc")
                .join(items.select(F.col("uid").alias("item"), "item_id", "grams"), "item")
                .select("doc_id", "item_id",
                        F.size(F.array_intersect("grams", "held")).cast("long").alias("n_shared"),
                        F.size("grams").cast("long").alias("n_item"), "h1", "h2"))
    return (verified.withColumn("containment", F.col("n_shared") / F.col("n_item"))
            .where(F.col("containment") >= threshold)
            .select("doc_id", "item_id", "n_shared", "n_item", "containment", "h1", "h2"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item; all columns stay. A phrase of
    one to four words tells nothing of a longer document, which stays."""
    with scratch(docs.sparkSession):
        found = materialise(find_items(docs, items).select("doc_id", "h1", "h2").distinct(), "benchmark-found", lasting=True)
    marks = ["_strata_h1", "_strata_h2"]
    tagged = docs.withColumns(dict(zip(marks, text_key(docs["text"]))))
    same = (tagged["doc_id"].cast("long").eqNullSafe(found["doc_id"]) & (tagged[marks[0]] == found["h1"])
            & (tagged[marks[1]] == found["h2"]))
    return tagged.join(found, same, "left_anti").drop(*marks)


def op10_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """All ``benchmark`` items found in all ``documents``."""
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), inside=True).drop("h1", "h2")


# Words of the lower-cased text; shingles of five, or of all words of a shorter item.
_WORDS = """SELECT row_number() OVER () AS rid, {id} AS id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w
  FROM {table} WHERE text IS NOT NULL"""
_GRAMS = "unnest(list_transform(range(len(w) - k + 1), lambda i: w[i + 1:i + k])) AS s"
ORACLE_OP10 = f"""
WITH i AS (SELECT DISTINCT rid, id, k, {_GRAMS} FROM (
  SELECT *, least(len(w), 5) AS k FROM ({_WORDS.format(id="item_id", table="benchmark")}) WHERE len(w) > 0)),
d AS (SELECT DISTINCT rid, id, k, {_GRAMS} FROM ({_WORDS.format(id="doc_id", table="documents")}) AS t
  JOIN (SELECT DISTINCT k FROM i) AS sizes ON len(w) >= sizes.k),
n AS (SELECT rid, count(*) AS n_item FROM i GROUP BY 1)
SELECT doc_id, item_id, n_shared, n_item, n_shared / n_item AS containment FROM (
  SELECT any_value(d.id) AS doc_id, any_value(i.id) AS item_id, count(*) AS n_shared, any_value(n.n_item) AS n_item
  FROM d JOIN i USING (k, s) JOIN n ON n.rid = i.rid GROUP BY d.rid, i.rid)
WHERE n_shared / n_item >= {THRESHOLD}
"""
