"""Removal of sentences in runs that occurred before: substring dedup.

A text is cut into sentences: behind a line end, behind a stop with white space
(or the end) before the next word, whatever marks stand between, and behind a
stop of scripts that put no blank there. Two kinds of spans are identified by a
128-bit hash of their words in lower case (``passages``):

- From every sentence on, the fewest consecutive ones that are ``RUN`` at least
  and have ``WORDS`` words together.
- ``LONG`` words from each word on that has the smallest hash of some ``LONG``
  consecutive words. Their places depend on nothing but the words around, so
  every run of ``2 * LONG - 1`` words that occurs again holds one in both
  places, whatever its sentences and marks.

A letter of a script without blanks counts as a word (Thai, Chinese, Japanese).
``fixed_runs`` is a narrower rule: exactly ``RUN`` sentences, ended by ``. ! ?``
directly before white space and cut at every ``LONG``-th word. Of spans that occur more than once anywhere, all but the
first occurrence (smallest doc_id, then place in the text) are cut out.

Hashes are first counted over all texts; a bitmap of bounded size then lets a
second pass send only spans that may repeat, which are joined globally.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bits
from .common import materialise, scratch, table, text_key
from .text import chunks, code_points, range_hashes, word_ranges
from .winnow import _window_min

RUN = 2
WORDS = 12
LONG = 25
_PLACE = np.uint64((1 << 32) - 1)
_END = np.frombuffer(".!?".encode("utf-32-le"), dtype="<u4")
#: Stops that white space must follow, behind other marks or not; stops that end a sentence by themselves.
_STOPS = np.frombuffer(".!?\u2026\u203c\u203d\u2047\u2048\u2049\u061f\u06d4\u0700\u0701\u0702\u0589\u1362\u1367\u1368"
                       .encode("utf-32-le"), dtype="<u4")
_FULL_STOPS = np.frombuffer("\u3002\uff0e\uff01\uff1f\uff61\u0964\u0965\u104a\u104b\u17d4\u17d5\u0f0d\u0f0e\u1803\u1809"
                            .encode("utf-32-le"), dtype="<u4")


def _is_space(cp: np.ndarray) -> np.ndarray:
    return (cp == 32) | ((cp >= 9) & (cp <= 13)) | (cp == 0xA0) | (cp == 0x85) | ((cp >= 0x2000) & (cp <= 0x200A)) | (
        cp == 0x2028) | (cp == 0x2029) | (cp == 0x3000)


def _sentences(texts: list[str], long: int):
    """Of the joined texts: their characters, ends, each word's start and hash,
    and each sentence's first word and text."""
    cp = code_points("".join(t + "\n" for t in texts))
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    start, _, value = word_ranges(cp)
    stop = np.isin(cp, _END) & np.concatenate([_is_space(cp[1:]), [True]])
    stop |= cp == 10
    sentence = np.cumsum(stop)[start] if len(start) else np.zeros(0, np.int64)
    new = np.concatenate([[True], sentence[1:] != sentence[:-1]])[:len(start)]
    first = np.flatnonzero(new)
    place = np.arange(len(start)) - np.repeat(first, np.diff(np.concatenate([first, [len(start)]])))
    first = np.flatnonzero(place % long == 0)
    return cp, ends, start, value, first, np.searchsorted(ends, start[first], side="right")


def _ranges(cp, ends, start, value, begin, end) -> dict[str, np.ndarray]:
    """The spans of the words ``begin`` to ``end`` (exclusive), each within a text."""
    owner = np.searchsorted(ends, start[begin], side="right")
    before = np.concatenate([[0], ends])[owner]
    # A span reaches to the next word, a text's last one to its end.
    close = np.minimum(np.concatenate([start, [len(cp)]])[end], ends[owner] - 1)
    return {"text": owner, "begin": start[begin] - before, "end": close - before,
            "a": range_hashes(value, begin, end, 1).view(np.int64),
            "b": range_hashes(value, begin, end, 2).view(np.int64)}


def fixed_runs(texts: list[str], run: int = RUN, words: int = WORDS, long: int = LONG) -> dict[str, np.ndarray]:
    """The spans of exactly ``run`` sentences, if of ``words`` words: text number, first
    and end character (in code points, from the text's start) and two hashes."""
    cp, ends, start, value, first, text = _sentences(texts, long)
    n = max(0, len(first) - run + 1)
    begin = first[:n]
    end = np.concatenate([first, [len(start)]])[run:run + n]
    ok = (text[:n] == text[run - 1:run - 1 + n]) & (end - begin >= words)
    return _ranges(cp, ends, start, value, begin[ok], end[ok])


def _stopped(cp: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For each word, whether a sentence ends between the word before and it."""
    at = np.arange(len(cp))
    stop = np.maximum.accumulate(np.where(np.isin(cp, _STOPS), at, -1))
    blank = np.maximum.accumulate(np.where(_is_space(cp), at, -1))
    end = np.maximum.accumulate(np.where((cp == 10) | np.isin(cp, _FULL_STOPS), at, -1))
    # White space behind a stop: one is its last place with a stop before it.
    behind = np.where(blank >= 0, stop[blank], -1)
    last = np.maximum(behind, end)[start]
    return last >= np.concatenate([[0], start[:-1]])[:len(start)]


def passages(texts: list[str], run: int = RUN, words: int = WORDS, long: int = LONG) -> dict[str, np.ndarray]:
    """As ``fixed_runs``, the spans of both kinds: of the fewest sentences from
    each one on that are ``run`` at least and have ``words`` words together, and
    of ``long`` words at places chosen by the words."""
    cp = code_points("".join(t + "\n" for t in texts))
    ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    start, _, value = word_ranges(cp, unspaced=True)
    text = np.searchsorted(ends, start, side="right")
    first = np.flatnonzero(_stopped(cp, start) | (np.diff(text, prepend=-1) != 0))
    bounds = np.concatenate([first, [len(start)]])
    last = np.maximum(np.arange(len(first)) + run, np.searchsorted(bounds, first + words))
    ok = last <= len(first)
    ok[ok] = text[first[last[ok] - 1]] == text[first[ok]]
    begin, end = first[ok], bounds[last[ok]]
    if len(start) >= long:
        whole = text[long - 1:] == text[:len(text) - long + 1]  # windows within one text
        least = _window_min((value & ~_PLACE) | np.arange(len(value), dtype=np.uint64), long) & _PLACE
        piece = np.unique(least[whole].astype(np.int64))
        piece = piece[piece + long <= len(start)]
        piece = piece[text[piece + long - 1] == text[piece]]
        begin, end = np.concatenate([begin, piece]), np.concatenate([end, piece + long])
    return _ranges(cp, ends, start, value, begin, end)


def _count(rule, run: int, words: int, long: int):
    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts):
                found, n = np.unique(rule([t or "" for t in texts[a:b]], run, words, long)["a"], return_counts=True)
                yield pd.DataFrame({"a": found, "n": n})
    return go


def _send(rule, run: int, words: int, long: int, shared):
    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = np.frombuffer(shared.value, np.uint8)
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in chunks(texts):
                found = pd.DataFrame(rule([t or "" for t in texts[a:b]], run, words, long))
                found = found[bits.contains(wanted, found["a"].to_numpy())] if len(found) else found
                if len(found):
                    keys = pdf[["doc_id", "h1", "h2"]].iloc[a + found["text"].to_numpy()].reset_index(drop=True)
                    yield pd.concat([keys, found.drop(columns="text").reset_index(drop=True)], axis=1)
    return go


def later_spans(docs: DataFrame, run: int = RUN, words: int = WORDS, long: int = LONG, rule=fixed_runs) -> DataFrame:
    """(doc_id, h1, h2, begins, ends): character ranges of spans that occurred before."""
    h1, h2 = text_key(F.col("text"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).where("text IS NOT NULL")
    again = materialise(source.select("text").mapInPandas(_count(rule, run, words, long), "a long, n long")
                        .groupBy("a").agg(F.sum("n").alias("n")).where("n > 1").select("a"), "span-hashes")
    shared = docs.sparkSession.sparkContext.broadcast(bits.build(again).tobytes())
    found = materialise(source.select("doc_id", "text", h1.alias("h1"), h2.alias("h2")).mapInPandas(
        _send(rule, run, words, long, shared), "doc_id long, h1 long, h2 long, begin long, end long, a long, b long"), "spans")
    at = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h1", "h2", "begin")
    firsts = found.groupBy("a", "b").agg(F.min(at).alias("first"))
    later = (found.join(firsts, ["a", "b"]).where(at != F.col("first"))
             .select("doc_id", "h1", "h2", "begin", "end").distinct())
    return (later.groupBy("doc_id", "h1", "h2")
            .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("r"))
            .select("doc_id", "h1", "h2", F.col("r.begin").alias("begins"), F.col("r.end").alias("ends")))


_KEPT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType()),
                      T.StructField("n_spans", T.LongType())])


@F.pandas_udf(_KEPT)
def _cut(texts: pd.Series, begins: pd.Series, ends: pd.Series) -> pd.DataFrame:
    out = []
    for text, b, e in zip(texts, begins, ends):
        if text is None or b is None or not len(b):
            out.append((text, 0, 0))
            continue
        e = np.maximum.accumulate(np.asarray(e))
        new = np.concatenate([[True], np.asarray(b)[1:] > e[:-1]])
        b, e = np.asarray(b)[new], e[np.concatenate([new[1:], [True]])]
        out.append(("".join(text[x:y] for x, y in zip([0, *e], [*b, len(text)])), int((e - b).sum()), len(b)))
    return pd.DataFrame(out, columns=["text", "n_removed", "n_spans"])


def remove_later_spans(docs: DataFrame, run: int = RUN, words: int = WORDS, long: int = LONG,
                       rule=fixed_runs) -> DataFrame:
    """``docs`` (doc_id, text) without sentences in a span (by ``rule``) that occurred before.

    One row per input row: doc_id, n_chars (of the input), n_removed
    (characters cut), n_spans (places cut) and text (what is left). A NULL text
    stays NULL and an empty or wordless one as it is. Rows with a NULL doc_id
    come after all others. Rows that repeat a doc_id and its text are the same
    document and lose the same spans; other columns are ignored.
    """
    with scratch(docs.sparkSession):
        later = materialise(later_spans(docs, run, words, long, rule), "later-spans", lasting=True)
    h1, h2 = text_key(F.col("text"))
    tagged = docs.select(F.col("doc_id"), F.col("text"), h1.alias("t1"), h2.alias("t2"))
    joined = tagged.join(later, tagged["doc_id"].cast("long").eqNullSafe(later["doc_id"])
                         & (tagged["t1"] == later["h1"]) & (tagged["t2"] == later["h2"]), "left")
    return (joined.select(tagged["doc_id"], F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"),
                          _cut("text", "begins", "ends").alias("k"))
            .select("doc_id", "n_chars", "k.n_removed", "k.n_spans", "k.text"))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` without sentence spans that occurred before."""
    return remove_later_spans(table(spark, sf_dir, "documents"), rule=passages)
