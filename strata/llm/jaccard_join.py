"""N-gram Jaccard join: MinHash banding, then exact check on full n-gram sets.

Steps, all over whole tables:

1. One pass over the texts gives each row its set of word n-grams, a 128-bit
   key of that set and its band hashes. Rows with equal sets form one class,
   and only its representative goes on, so thousands of copies cost one row.
2. Band hashes are shuffled; a band value that two or more classes share is a
   bucket. Buckets with the same members are one bucket.
3. Members of a bucket are dealt into blocks of about ``BLOCK``; each pair of
   blocks is one group of bounded size. A pair of classes is verified in the
   smallest bucket that they share, on the full n-gram sets. A group sends on
   link counts and a spanning forest of its links, never its pairs.
4. Connected components of the forests give each row its class id.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import groups, materialise, scratch, shuffle_width, table, text_key
from .components import connected_components
from .text import chunks, mix64, shingle_hashes, shingle_sets

NGRAM = 5
THRESHOLD = 0.8
#: Wanted share of linked pairs (at the threshold itself) that share a band.
RECALL = 0.9995
MAX_HASHES = 128
#: Members of a bucket in one block.
BLOCK = 512


def choose_banding(threshold: float = THRESHOLD, recall: float = RECALL,
                   most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which the bands that the wanted
    recall needs at the threshold stay within ``most`` hashes. More rows mean
    fewer false candidates."""
    best = (math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows <= most:
            best = (bands, rows)
    return best


def minhashes(hashes: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """(texts, count) minima of ``count`` hash functions over each non-empty range."""
    seeds = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64))
    multiply, add = seeds[:count] | np.uint64(1), seeds[count:]
    out = np.empty((len(offsets) - 1, count), dtype=np.uint64)
    for i in range(count):
        h = hashes * multiply[i]
        h += add[i]
        out[:, i] = np.minimum.reduceat(h, offsets[:-1])
    return out


def band_hashes(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands): one 64-bit value per band, different from band to band."""
    out = np.empty((len(minima), bands), dtype=np.uint64)
    for b in range(bands):
        h = np.full(len(minima), b + 1, dtype=np.uint64)
        for r in range(rows):
            h = mix64(h ^ minima[:, b * rows + r]) * np.uint64(0x9E3779B97F4A7C15)
        out[:, b] = h
    return out.view(np.int64)


def _signatures(size: int, bands: int, rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts, 200_000):
                hashes, offsets = shingle_hashes([t or "" for t in texts[a:b]], size)
                n = np.zeros(b - a, dtype=np.int32)
                key = np.zeros((b - a, 2), dtype=np.int64)
                for i in range(b - a):
                    own = np.unique(hashes[offsets[i]:offsets[i + 1]])
                    n[i] = len(own)
                    key[i] = own.sum().view(np.int64), np.bitwise_xor.reduce(mix64(own + np.uint64(len(own)))).view(np.int64)
                full = np.flatnonzero(np.diff(offsets) > 0)
                out = pdf.iloc[a:b].drop(columns="text").assign(n_grams=n, set_a=key[:, 0], set_b=key[:, 1])
                values: list = [None] * (b - a)
                if len(full):
                    own = band_hashes(minhashes(hashes, offsets[[*full, -1]], bands * rows), bands, rows)
                    for j, i in enumerate(full):
                        values[i] = own[j]
                yield out.assign(bands=values)
    return run


def _sets(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts, 2_000_000):
                yield pdf.iloc[a:b].drop(columns="text").assign(
                    grams=[x.view(np.int64) for x in shingle_sets(texts[a:b], size)])
    return run


def _shared(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets numbered ``a`` with those numbered ``b``."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(new) - 1
    twice = np.bincount(column)[column] > 1
    owner, column = owner[twice], column[twice]
    total = np.zeros((len(a), len(b)), dtype=np.float64)
    if not len(column):
        return total
    column = np.cumsum(np.concatenate([[0], np.diff(column) != 0]))
    width = 4096
    for low in range(0, column[-1] + 1, width):
        i, j = np.searchsorted(column, [low, low + width])
        m = np.zeros((len(sets), width), dtype=np.float32)
        m[owner[i:j], column[i:j] - low] = 1
        total += m[a] @ m[b].T
    return total


def _verify(threshold: float):
    """Groups (bucket, x, y) of members -> links and a spanning forest."""
    def pairs(g: pd.DataFrame) -> pd.DataFrame | None:
        bucket, x, y = g["bucket"].iloc[0], g["x"].iloc[0], g["y"].iloc[0]
        block = g["block"].to_numpy()
        a, b = np.flatnonzero(block == x), np.flatnonzero(block == y)
        if not len(a) or not len(b) or len(g) < 2:
            return None
        earlier: dict[int, int] = {}
        rows, cols = [], []
        for i, own in enumerate(g["buckets"]):
            for k in own:
                if k < bucket:
                    rows.append(i)
                    cols.append(earlier.setdefault(k, len(earlier)))
        sets = [np.asarray(s).view(np.uint64) for s in g["grams"]]
        size = np.array([len(s) for s in sets], dtype=np.float64)
        shared = _shared(sets, a, b)
        linked = shared / (size[a][:, None] + size[b][None, :] - shared) >= threshold
        if earlier:
            done = np.zeros((len(g), len(earlier)), dtype=np.float32)
            done[rows, cols] = 1
            linked &= (done[a] @ done[b].T) == 0
        if x == y:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return None
        copies = g["n_copies"].to_numpy()
        texts, docs = np.zeros(len(g), dtype=np.int64), np.zeros(len(g), dtype=np.int64)
        texts[a] += linked.sum(axis=1)
        docs[a] += linked @ copies[b]
        if x != y:
            texts[b] += linked.sum(axis=0)
            docs[b] += copies[a] @ linked
        uid = g["uid"].to_numpy()
        root = uid.copy()
        while True:
            before = root.copy()
            high = np.iinfo(np.int64).max
            root[a] = np.minimum(root[a], np.where(linked, root[b][None, :], high).min(axis=1))
            root[b] = np.minimum(root[b], np.where(linked, root[a][:, None], high).min(axis=0))
            if (root == before).all():
                break
        keep = texts > 0
        return pd.DataFrame({"uid": uid[keep], "texts": texts[keep], "docs": docs[keep], "root": root[keep]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for g in groups(batches, ["bucket", "x", "y"]):
            if (out := pairs(g)) is not None:
                held.append(out)
            if len(held) >= 500:
                yield pd.concat(held)
                held = []
        if held:
            yield pd.concat(held)
    return run


def jaccard_join(docs: DataFrame, size: int = NGRAM, threshold: float = THRESHOLD,
                 recall: float = RECALL) -> DataFrame:
    """Near-duplicate classes of ``docs`` (columns doc_id, text; others ignored).

    One row per input row: doc_id, class_id (the smallest doc_id of the
    connected group of links), set_id (the smallest doc_id with exactly the
    same n-grams), n_copies (rows with exactly the same n-grams, itself
    included) and n_links (other rows whose n-gram sets reach the threshold),
    plus class_key (names the class also where all its doc_ids are NULL) and
    h1, h2 (identity of the text).

    A NULL, empty or wordless text has no n-grams and no links: it is its own
    class. Rows with a NULL doc_id take part and sort last as representatives.
    Repeated rows are copies of each other. No rows give no rows.
    """
    spark = docs.sparkSession
    bands, rows = choose_banding(threshold, recall)
    h1, h2 = text_key(F.col("text"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    signed = (source.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"),
                            F.monotonically_increasing_id().alias("uid"))
              .mapInPandas(_signatures(size, bands, rows),
                           "doc_id long, h1 long, h2 long, uid long, n_grams int, set_a long, set_b long, bands array<long>"))
    signed = materialise(signed, "jaccard-signatures")
    full = signed.where("n_grams > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid", "h1", "h2")).alias("r")
    reps = full.groupBy("set_a", "set_b", "n_grams").agg(first, F.count("*").alias("n_copies"))
    reps = materialise(reps.select("set_a", "set_b", "n_grams", "r.uid", "r.doc_id", "r.h1", "r.h2", "n_copies"),
                       "jaccard-classes")

    banded = (full.select("uid", "bands").join(reps.select("uid"), "uid", "left_semi")
              .select("uid", F.posexplode("bands").alias("band", "value"))
              .select("uid", F.xxhash64("band", "value").alias("bucket")))
    banded = materialise(banded, "jaccard-bands")
    buckets = (banded.groupBy("bucket")
               .agg(F.count("*").alias("n"), F.sum(F.xxhash64("uid").cast("decimal(38,0)")).alias("f"),
                    F.bit_xor(F.xxhash64(F.lit(7), "uid")).alias("g"))
               .where("n > 1").groupBy("n", "f", "g").agg(F.min("bucket").alias("bucket"))
               .select("bucket", "n"))
    members = materialise(banded.join(buckets, "bucket"), "jaccard-members")
    wanted = (members.groupBy("uid").agg(F.array_sort(F.collect_set("bucket")).alias("buckets"))
              .join(reps.select("uid", "doc_id", "h1", "h2", "n_copies"), "uid"))
    same = ((F.col("w.doc_id").eqNullSafe(F.col("s.doc_id"))) & (F.col("w.h1") == F.col("s.h1"))
            & (F.col("w.h2") == F.col("s.h2")))
    texts = source.select("doc_id", "text", h1.alias("h1"), h2.alias("h2")).alias("s")
    chosen = (texts.join(wanted.alias("w"), same)
              .select("w.uid", "w.n_copies", "w.buckets", "s.text"))
    sets = materialise(chosen.mapInPandas(_sets(size), "uid long, n_copies long, buckets array<long>, grams array<long>"),
                       "jaccard-sets")
    sets = sets.dropDuplicates(["uid"])  # rows repeated with the representative's id and text
    blocks = F.ceil(F.col("n") / F.lit(float(BLOCK))).cast("long")
    dealt = (members.withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64(F.lit(5), "uid"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("uid", "bucket", "block", F.least("block", "other").alias("x"),
                     F.greatest("block", "other").alias("y")))
    groups_ = (dealt.join(sets, "uid")
               .repartition(shuffle_width(spark), "bucket", "x", "y")
               .sortWithinPartitions("bucket", "x", "y"))
    links = materialise(groups_.mapInPandas(_verify(threshold), "uid long, texts long, docs long, root long"),
                        "jaccard-links")

    parts = connected_components(links.select("uid", "root"))
    named = (parts.withColumnRenamed("node", "uid").join(reps.select("uid", "doc_id"), "uid")
             .select("uid", "root", "doc_id"))
    class_of = named.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("r")).select("root", F.col("r.doc_id").alias("class_id"))
    counts = links.groupBy("uid").agg(F.sum("docs").alias("docs"))
    known = (reps.join(named.select("uid", "root"), "uid", "left").join(class_of, "root", "left")
             .join(counts, "uid", "left")
             .select("set_a", "set_b", "n_grams", F.coalesce("root", "uid").alias("class_key"),
                     F.col("doc_id").alias("set_id"),
                     F.coalesce("class_id", "doc_id").alias("class_id"), "n_copies",
                     (F.col("n_copies") - 1 + F.coalesce("docs", F.lit(0))).alias("n_links")))
    known = materialise(known, "jaccard-known")
    linked = full.join(known, ["set_a", "set_b", "n_grams"]).select(
        "doc_id", "class_id", "set_id", "n_copies", "n_links", "class_key", "h1", "h2")
    alone = signed.where("n_grams = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("set_id"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"),
        F.col("uid").alias("class_key"), "h1", "h2")
    return linked.unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the document
    with the smallest doc_id stays (rows that repeat it once); all columns stay."""
    key = ["doc_id", "h1", "h2"]
    with scratch(docs.sparkSession):
        found = materialise(jaccard_join(docs).where("n_links > 0"), "jaccard-duplicates", lasting=True)
    rows = found.groupBy(*key).agg(F.count("*").alias("n"), F.min("class_key").alias("class_key"))
    stays = (rows.groupBy("class_key")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), *key)).alias("s"))
             .select(*(F.col(f"s.{k}") for k in key)))
    marks = ["_strata_h1", "_strata_h2"]

    def same(left: DataFrame, right: DataFrame, marks=("h1", "h2")) -> Column:
        return (left["doc_id"].eqNullSafe(right["doc_id"]) & (left[marks[0]] == right["h1"])
                & (left[marks[1]] == right["h2"]))

    drop = rows.join(stays, same(rows, stays), "left_anti").select(key)
    tagged = docs.withColumns(dict(zip(marks, text_key(docs["text"]))))
    kept = tagged.join(drop, same(tagged, drop, marks), "left_anti")
    repeated = rows.where("n > 1").join(stays, same(rows, stays), "left_semi").select(key)
    if not repeated.isEmpty():
        again = tagged.join(repeated, same(tagged, repeated, marks), "left_semi").dropDuplicates(["doc_id", *marks])
        kept = kept.join(repeated, same(kept, repeated, marks), "left_anti").unionByName(again)
    return kept.drop(*marks)


def op2_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents``: 5-word n-grams, Jaccard 0.8."""
    return jaccard_join(table(spark, sf_dir, "documents")).drop("class_key", "h1", "h2")


# All pairs of different n-gram sets that share one, and the closure of the links.
ORACLE_OP2 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}_]+') AS w FROM documents
), g AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {NGRAM} THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - {NGRAM - 1}), lambda i: array_to_string(w[i + 1:i + {NGRAM}], ' ')) END)) AS s FROM w
), c AS (
  SELECT row_number() OVER () AS sid, s, min(doc_id) AS set_id, count(*) AS n_copies FROM g WHERE len(s) > 0 GROUP BY s
), x AS (SELECT sid, len(s) AS size, unnest(s) AS t FROM c),
e AS (
  SELECT a, b FROM (SELECT a.sid AS a, b.sid AS b, any_value(a.size) AS m, any_value(b.size) AS n, count(*) AS k
                    FROM x a JOIN x b ON a.t = b.t AND a.sid <> b.sid GROUP BY ALL)
  WHERE k / (m + n - k) >= {THRESHOLD}
), r AS (
  SELECT sid AS a, sid AS b FROM c UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), k AS (SELECT r.a AS sid, min(set_id) AS class_id FROM r JOIN c ON c.sid = r.b GROUP BY 1),
l AS (SELECT e.a AS sid, sum(n_copies) AS links FROM e JOIN c ON c.sid = e.b GROUP BY 1)
SELECT doc_id, class_id, set_id, n_copies, (n_copies - 1 + coalesce(links, 0))::BIGINT AS n_links
FROM g JOIN c USING (s) JOIN k USING (sid) LEFT JOIN l USING (sid)
UNION ALL SELECT doc_id, doc_id, doc_id, 1, 0 FROM g WHERE len(s) = 0
"""
