"""Removal of long byte strings that occur more than once anywhere.

Every byte covered by a ``LENGTH``-byte window that also starts elsewhere goes.

1. One pass over the texts finds the anchors of all windows (``winnow``) and
   counts them; what follows looks only at anchors that occur again. A bitmap
   of bounded size tells a second pass which those are.
2. That pass cuts out, around each such anchor, the context that its windows
   cover. Equal windows have equal anchors at equal offsets, so only contexts
   of one anchor need comparing. Equal contexts are counted together, however
   many texts share them; all windows of a context that occurs twice repeat.
3. The different contexts of an anchor are compared by a suffix array over all
   of them (``suffix_array``): a window repeats if its neighbour in the array
   agrees for the window's length. The anchor's own bytes are equal in all of
   them, so they count as one symbol. An anchor with more than ``MOST``
   different contexts is not sorted in one task: its windows are counted by
   their hashes over all tasks.
4. The repeated ranges go back to the texts, by the identity of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bits
from .common import materialise, scratch, shuffle_width, table, text_key
from .suffix_array import suffix_array
from .winnow import Pieces, RangeHashes, batches

LENGTH = 400
#: Bytes of an anchor: three quarters of the window.
GRAM = 300
#: Bytes of a repeated passage in a corpus: fewer than 50 words of prose take
#: (285 at least in the test tables), more than most license and menu lines.
PASSAGE = 240
#: Different contexts of one anchor that are sorted in one task.
MOST = 1024
#: Symbols sorted in one suffix array (a whole anchor at least).
SYMBOLS = 60_000


def _bytes(texts: pd.Series) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _count_anchors(length: int, gram: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        for pdf in frames:
            for parts in batches(_bytes(pdf["text"]), length):
                held.append(Pieces(parts, length, gram).anchors())
                if sum(map(len, held)) > 500_000:
                    anchor, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pd.DataFrame({"anchor": anchor, "n": n})
                    held = []
        if held:
            anchor, n = np.unique(np.concatenate(held), return_counts=True)
            yield pd.DataFrame({"anchor": anchor, "n": n})
    return run


def _cut_contexts(length: int, gram: int, shared):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = np.frombuffer(shared.value, np.uint8)
        for pdf in frames:
            h1, h2 = pdf["h1"].to_numpy(), pdf["h2"].to_numpy()
            for parts in batches(_bytes(pdf["text"]), length):
                p = Pieces(parts, length, gram)
                anchors = p.anchors()
                which = np.flatnonzero(bits.contains(wanted, anchors))
                if not len(which):
                    continue
                raw = p.data.tobytes()
                first, place = p.first[which], p.place[which]
                end = first + p.windows[which] + length - 1
                yield pd.DataFrame({
                    "anchor": anchors[which], "content": p.contents(which), "h1": h1[p.text[which]],
                    "h2": h2[p.text[which]], "first": p.offset[which], "windows": p.windows[which].astype(np.int32),
                    "before": [raw[a:b] for a, b in zip(first, place)],
                    "after": [raw[a:b] for a, b in zip(place + gram, end)]})
    return run


def _runs(marked: np.ndarray) -> np.ndarray:
    """[from, to, from, to ...] of the runs of True, both inclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    edge[1::2] -= 1
    return edge


def _repeated(contexts: list[tuple], need: int) -> list[np.ndarray]:
    """For (anchor, before, after, windows) contexts: which windows repeat in another one.

    ``need`` symbols make a window, its anchor counting as one.
    """
    text: list[int] = []
    starts, anchors = [], {}
    for anchor, before, after, _ in contexts:
        starts.append(len(text))
        text += [b + 2 for b in before]
        text.append(258 + anchors.setdefault(anchor, len(anchors)))
        text += [b + 2 for b in after]
        text.append(1)
    text.append(0)
    order = np.array(suffix_array(text))
    symbols = np.array(text, dtype=np.int32)
    is_window = np.zeros(len(text), dtype=bool)
    for at, c in zip(starts, contexts):
        is_window[at:at + c[3]] = True
    pair = np.flatnonzero(is_window[order[:-1]] & is_window[order[1:]])
    again = np.zeros(len(text), dtype=bool)
    rows = np.lib.stride_tricks.sliding_window_view(symbols, need)
    for low in range(0, len(pair), 10_000):
        a, b = order[pair[low:low + 10_000]], order[pair[low:low + 10_000] + 1]
        same = (rows[a] == rows[b]).all(axis=1)
        again[a[same]] = True
        again[b[same]] = True
    return [again[at:at + c[3]] for at, c in zip(starts, contexts)]


def _compare(need: int):
    """Contexts sorted by anchor -> the repeated windows of those that occur once."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        keys: list[tuple] = []
        symbols = 0

        def done() -> pd.DataFrame:
            out = [(*k[:2], _runs(r)) for k, r in zip(keys, _repeated(held, need)) if k[2] == 1 and r.any()]
            return pd.DataFrame(out, columns=["anchor", "content", "ranges"])
        for pdf in frames:
            for anchor, content, n, before, after, windows in zip(*(pdf[c].tolist() for c in (
                    "anchor", "content", "n", "before", "after", "windows"))):
                if symbols > SYMBOLS and anchor != held[-1][0]:
                    yield done()
                    held, keys, symbols = [], [], 0
                held.append((anchor, before, after, windows))
                keys.append((anchor, content, n))
                symbols += len(before) + len(after) + 2
        if held:
            yield done()
    return run


def _window_hashes(need: int):
    """Contexts -> one row for each window, with a 128-bit hash of it."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for anchor, content, n, before, after, windows in zip(*(pdf[c].tolist() for c in (
                    "anchor", "content", "n", "before", "after", "windows"))):
                data = np.frombuffer(before + after, dtype=np.uint8)
                at = np.arange(windows)
                one, two = (RangeHashes(data, w).of(at, at + need - 1).view(np.int64) for w in (0, 1))
                out.append(pd.DataFrame({"anchor": anchor, "content": content, "n": n, "at": at,
                                         "left": len(before) - at, "w1": one, "w2": two}))
            if out:
                yield pd.concat(out)
    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """(h1, h2, starts, ends): repeated byte ranges of each different text that
    has any, as sorted arrays (ends exclusive; ranges may overlap). NULL texts
    and those shorter than ``length`` have none."""
    spark = docs.sparkSession
    need = length - gram + 1
    h1, h2 = text_key(F.col("text"))
    texts = docs.select("text").where(F.octet_length("text") >= length)
    again = materialise(texts.mapInPandas(_count_anchors(length, gram), "anchor long, n long")
                        .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"),
                        "suffix-anchors")
    shared = spark.sparkContext.broadcast(bits.build(again).tobytes())
    pieces = materialise(texts.select("text", h1.alias("h1"), h2.alias("h2")).mapInPandas(
        _cut_contexts(length, gram, shared),
        "anchor long, content long, h1 long, h2 long, first long, windows int, before binary, after binary"),
        "suffix-pieces")
    contexts = pieces.groupBy("anchor", "content", "windows", "before", "after").agg(F.count("*").alias("n"))
    contexts = materialise(contexts, "suffix-contexts")
    per_anchor = contexts.groupBy("anchor").agg(F.count("*").alias("different"))
    several = contexts.join(per_anchor.where("different > 1"), "anchor")
    sorted_ = (several.where(F.col("different") <= most).drop("different")
               .repartition(shuffle_width(spark), "anchor").sortWithinPartitions("anchor")
               .mapInPandas(_compare(need), "anchor long, content long, ranges array<int>"))
    windows = materialise(several.where(F.col("different") > most).mapInPandas(
        _window_hashes(need), "anchor long, content long, n long, at int, left int, w1 long, w2 long"),
        "suffix-windows")
    same = ["anchor", "left", "w1", "w2"]
    seen = windows.groupBy(*same).agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    counted = (windows.where("n = 1").join(seen, same, "left_semi")
               .groupBy("anchor", "content").agg(F.collect_list("at").alias("at"))
               .select("anchor", "content", F.flatten(F.transform("at", lambda x: F.array(x, x))).alias("ranges")))
    whole = contexts.where("n > 1").select(
        "anchor", "content", F.array(F.lit(0), F.col("windows") - 1).alias("ranges"))
    decided = materialise(sorted_.unionByName(counted).unionByName(whole), "suffix-decided")
    ranges = F.transform(F.sequence(F.lit(0), F.size("ranges") - 2, F.lit(2)),
                         lambda i: F.struct((F.col("first") + F.col("ranges")[i]).alias("s"),
                                            (F.col("first") + F.col("ranges")[i + 1] + length).alias("e")))
    marked = (pieces.select("anchor", "content", "h1", "h2", "first").join(decided, ["anchor", "content"])
              .select("h1", "h2", F.explode(ranges).alias("r")).select("h1", "h2", "r.s", "r.e").distinct())
    return (marked.groupBy("h1", "h2").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("r"))
            .select("h1", "h2", F.col("r.s").alias("starts"), F.col("r.e").alias("ends")))


def _merge(starts, ends) -> tuple[np.ndarray, np.ndarray]:
    if starts is None or not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts, ends = np.asarray(starts), np.maximum.accumulate(np.asarray(ends))
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.concatenate([new[1:], [True]])]


_CUT = T.StructType([T.StructField("kept", T.BinaryType()), T.StructField("n_removed", T.LongType()),
                     T.StructField("n_spans", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType()))])


@F.pandas_udf(_CUT)
def _cut(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    out = []
    for raw, s, e in zip(_bytes(texts), starts, ends):
        s, e = _merge(s, e)
        kept = b"".join(raw[a:b] for a, b in zip([0, *e], [*s, len(raw)]))
        out.append((kept, int((e - s).sum()), len(s), np.stack([s, e], axis=1).ravel()))
    return pd.DataFrame(out, columns=["kept", "n_removed", "n_spans", "spans"])


def _with_spans(docs: DataFrame, length: int, **options) -> DataFrame:
    with scratch(docs.sparkSession):
        spans = materialise(repeated_spans(docs, length, **options).select(
            F.col("h1").alias("_strata_h1"), F.col("h2").alias("_strata_h2"),
            F.col("starts").alias("_strata_starts"), F.col("ends").alias("_strata_ends")), "suffix-spans", lasting=True)
    tagged = docs.withColumns(dict(zip(("_strata_h1", "_strata_h2"), text_key(docs["text"]))))
    return tagged.join(spans, ["_strata_h1", "_strata_h2"], "left").drop("_strata_h1", "_strata_h2")


def remove_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """``docs`` with a column ``_strata_cut``: struct of kept (the remaining
    bytes), n_removed, n_spans and spans ([start, end, start, end ...]).

    A NULL text counts as empty. Copies of a text lose the same bytes, the
    first one too. Only ``text`` is looked at; all other columns stay.
    """
    cut = _cut("text", "_strata_starts", "_strata_ends").alias("_strata_cut")
    return _with_spans(docs, length, **options).select(*(F.col(f"`{c}`") for c in docs.columns), cut)


@F.pandas_udf(T.StringType())
def _cut_text(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    out = []
    for text, s, e in zip(texts, starts, ends):
        if text is not None and s is not None and len(s):
            raw = text.encode("utf-8", "surrogatepass")
            s, e = _merge(s, e)
            text = b"".join(raw[a:b] for a, b in zip([0, *e], [*s, len(raw)])).decode("utf-8", "ignore")
        out.append(text)
    return pd.Series(out, dtype=object)


def without_repeats(docs: DataFrame, length: int = PASSAGE) -> DataFrame:
    """``docs`` with strings of ``length`` bytes that occur again cut out of
    ``text``, and ``n_chars`` set anew where it is a column. A character that
    loses a byte goes; a NULL text stays NULL. All rows and columns stay."""
    out = _with_spans(docs, length, gram=length * 3 // 4).select(
        *(_cut_text("text", "_strata_starts", "_strata_ends").alias("text") if c == "text" else F.col(f"`{c}`")
          for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def op7_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes of all ``documents`` without 400-byte strings that occur again."""
    cut = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                      "_strata_cut.n_removed", "_strata_cut.n_spans",
                      F.sha2("_strata_cut.kept", 256).alias("kept_sha256"))


# Every window of every text by its hash; the repeated ones' bytes merged into runs.
ORACLE_OP7 = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents
), w AS (
  SELECT rid, p, md5_number(array_slice(b, p + 1, p + {LENGTH})) AS h
  FROM (SELECT rid, b, unnest(range(octet_length(b) - {LENGTH - 1})) AS p FROM d WHERE octet_length(b) >= {LENGTH})
), r AS (
  SELECT rid, p, coalesce(p > lag(p) OVER (PARTITION BY rid ORDER BY p) + {LENGTH}, true) AS fresh
  FROM w JOIN (SELECT h FROM w GROUP BY h HAVING count(*) > 1) USING (h)
), g AS (
  SELECT rid, run, min(p) AS s, max(p) + {LENGTH} AS e
  FROM (SELECT rid, p, sum(fresh::INT) OVER (PARTITION BY rid ORDER BY p) AS run FROM r) GROUP BY ALL
), k AS (
  SELECT rid, run, e AS a, coalesce(lead(s) OVER (PARTITION BY rid ORDER BY s, run), octet_length(b)) AS z, b, e - s AS gone
  FROM (SELECT rid, run, s, e FROM g UNION ALL SELECT rid, 0, 0, 0 FROM d) JOIN d USING (rid)
)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, n_removed, n_spans, sha256(unhex(kept)) AS kept_sha256
FROM (SELECT rid, string_agg(hex(array_slice(b, a + 1, z)), '' ORDER BY a, run) AS kept, sum(gone)::BIGINT AS n_removed,
             count(*) - 1 AS n_spans FROM k GROUP BY rid) JOIN d USING (rid)
"""
