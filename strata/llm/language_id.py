"""Language identification by a bit-sliced Bloom filter over letter trigrams.

Training counts, over all labelled texts, in how many texts of each language a
trigram occurs. A trigram is entered for every language in which it is common
(``MIN_RATE`` of its texts) and not far rarer than in the language where it is
most common (``MIN_SHARE``). The filter has ``POSITIONS`` rows; row ``p`` is a
bitmask of the languages that set bit ``p``. The AND of a trigram's ``HASHES``
rows is the mask of all languages that contain it, so one lookup serves every
language.

A text's mask bits are counted per language. A language whose column is filled
to the share ``f`` answers falsely with probability ``f ** HASHES``; the
counts are corrected for that, and the largest corrected share decides.

Trigrams are of three code points packed exactly into 63 bits, taken from the
lower-cased text whose runs of other characters than letters count as one
blank. The filter's size is fixed (``POSITIONS`` x languages / 8 bytes), so it
is broadcast whatever the corpus.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .text import chunks, code_points, mix64

POSITIONS = 1 << 20
HASHES = 3
MIN_RATE = 0.002
MIN_SHARE = 0.25
UNKNOWN = "und"
#: Rows of the filter that travel as one row.
SLICE = 1 << 14


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All trigrams of the texts, and each text's first (one more at the end)."""
    cp = code_points("\x00".join(["", *(t.lower().replace("\x00", " ") for t in texts), ""]))
    ends = np.flatnonzero(cp == 0)
    value = np.where(_letters()[cp], cp, 1).astype(np.uint64)
    value[ends] = 0
    # A text's edge is a blank too: ends are 0, blanks next to an end or a blank go.
    blank = value <= 1
    value = value[~(blank & np.concatenate([[False], blank[:-1]])) | (value == 0)]
    value = value[~((value == 1) & np.concatenate([value[1:] == 0, [False]]))]
    edge = np.flatnonzero(value == 0)
    value[edge] = 1
    if len(value) < 3:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    grams = (value[:-2] << np.uint64(42)) | (value[1:-1] << np.uint64(21)) | value[2:]
    middle = np.zeros(len(value), bool)
    middle[edge] = True
    inside = ~middle[1:-1]
    # Without a letter there is nothing but blanks between two edges.
    some = value > 1
    inside &= some[:-2] | some[1:-1] | some[2:]
    before = np.concatenate([[0], np.cumsum(inside)])
    # Trigram i has its middle at i + 1; those of text k lie between its edges.
    first = before[np.clip(edge, 0, len(inside))]
    return grams[inside], first.astype(np.int64)


def positions(grams: np.ndarray) -> np.ndarray:
    """(HASHES, n) filter rows of each trigram."""
    h = mix64(grams)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h + np.uint64(i) * step) & np.uint64(POSITIONS - 1)).astype(np.int64) for i in range(HASHES)])


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(lang, text) -> texts of each language that hold a trigram, per task."""
    held: list[pd.DataFrame] = []
    def summed() -> pd.DataFrame:
        return pd.concat(held).groupby(["lang", "gram"], as_index=False)["n"].sum()
    for pdf in batches:
        texts, langs = pdf["text"].tolist(), pdf["lang"].tolist()
        for a, b in chunks(texts):
            grams, first = trigrams(texts[a:b])
            by: dict[str, list] = {}
            for i in range(b - a):
                by.setdefault(langs[a + i], []).append(np.unique(grams[first[i]:first[i + 1]]))
            for lang, own in by.items():
                gram, n = np.unique(np.concatenate(own), return_counts=True)
                held.append(pd.DataFrame({"lang": lang, "gram": gram.view(np.int64), "n": n}))
        if sum(map(len, held)) > 2_000_000:
            held = [summed()]
            if len(held[0]) > 1_000_000:
                yield held.pop()
    if held:
        yield summed()


def _rows(languages: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = positions(pdf["gram"].to_numpy().view(np.uint64))
            yield pd.DataFrame({"position": at.ravel(), "lang": np.tile(pdf["lang"].to_numpy(), HASHES)})
    return run


class Filter:
    """The trained filter: ``rows`` is (POSITIONS, bytes of languages)."""

    def __init__(self, languages: list[str], rows: np.ndarray):
        self.languages, self.rows = languages, rows
        bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
        self.bits = bits.astype(np.int64)
        filled = self.counts(rows) / max(1, len(rows))
        self.false = np.minimum(filled ** HASHES, 0.999)

    def counts(self, masks: np.ndarray) -> np.ndarray:
        """How often each language's bit is set."""
        by = [np.bincount(masks[:, w], minlength=256) @ self.bits for w in range(masks.shape[1])]
        return np.concatenate(by)[:len(self.languages)]

    def masks(self, grams: np.ndarray) -> np.ndarray:
        at = positions(grams)
        found = self.rows[at[0]]
        for p in at[1:]:
            found &= self.rows[p]
        return found

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for a, b in chunks(texts):
            grams, first = trigrams([t or "" for t in texts[a:b]])
            masks = self.masks(grams) if self.languages else None
            for i in range(b - a):
                n = first[i + 1] - first[i]
                if not n or masks is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                share = self.counts(masks[first[i]:first[i + 1]]) / n
                share = np.clip((share - self.false) / (1 - self.false), 0, 1)
                best = int(np.argmax(share))
                langs.append(self.languages[best])
                scores.append(float(share[best]))
        return langs, scores


def train(labelled: DataFrame) -> Filter:
    """A filter from (text, lang) rows; NULLs and texts without letters don't count."""
    labelled = labelled.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    totals = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(totals)
    width = max(1, -(-len(languages) // 8))
    rows = np.zeros((POSITIONS, width), dtype=np.uint8)
    if not languages:
        return Filter([], rows)
    rate = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for kv in totals.items() for x in kv]), F.col("lang"))
    counted = (labelled.mapInPandas(_count, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")).select("lang", "gram", rate.alias("rate")))
    common = (counted.where(F.col("rate") >= MIN_RATE)
              .groupBy("gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("by"))
              .select("gram", F.explode(F.expr(f"filter(by, x -> x.rate >= {MIN_SHARE} * top)")).alias("x"))
              .select("gram", "x.lang"))
    number = {lang: i for i, lang in enumerate(languages)}

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros((SLICE, width), dtype=np.uint8)
        bit = pdf["lang"].map(number).to_numpy()
        np.bitwise_or.at(own, (pdf["position"].to_numpy() % SLICE, bit // 8), (1 << (bit % 8)).astype(np.uint8))
        return pd.DataFrame({"slice": [pdf["position"].iloc[0] // SLICE], "rows": [own.tobytes()]})

    slices = (common.mapInPandas(_rows(languages), "position long, lang string").distinct()
              .groupBy(F.expr(f"position div {SLICE}")).applyInPandas(pack, "slice long, rows binary"))
    for r in slices.collect():  # POSITIONS * width bytes in all, whatever the corpus
        rows[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] = np.frombuffer(r["rows"], np.uint8).reshape(SLICE, width)
    return Filter(languages, rows)


def identify(docs: DataFrame, model: Filter, text: str = "text"):
    """A column: struct(lang, score) of each row's text."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.rows.tobytes()))

    @F.pandas_udf("lang string, score double")
    def guess(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, raw = shared.value
        own = Filter(languages, np.frombuffer(raw, np.uint8).reshape(POSITIONS, -1))
        for texts in batches:
            langs, scores = own.predict(texts.tolist())
            yield pd.DataFrame({"lang": langs, "score": scores})
    return guess(docs[text])


def held_out(doc_id="doc_id"):
    """Whether a row is kept from training (never, for a NULL doc_id)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_on_documents(docs: DataFrame) -> Filter:
    return train(docs.where(F.col("doc_id").isNotNull() & ~held_out()))


def language_id(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang; others ignored):
    doc_id, held_out, lang_pred, score.

    Learns from rows with text, lang and doc_id that are not held out. A NULL
    text or one without a letter is ``und`` with score 0, as is every text if
    there is nothing to learn from. Equal scores go to the first language in
    alphabetical order. Repeated rows each give a row.
    """
    docs = docs.select(F.col("doc_id"), F.col("text"), F.col("lang"))
    found = identify(docs, train_on_documents(docs))
    return (docs.select("doc_id", held_out().alias("held_out"), found.alias("found"))
            .select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")))


#: Below this score a text reads like none of the learned languages.
LEAST_SCORE = 0.2


def keep_identified(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` in a learned language; all columns stay."""
    mark = "_strata_language"
    found = docs.withColumn(mark, identify(docs, train_on_documents(docs)))
    return found.where((F.col(f"{mark}.lang") != UNKNOWN) & (F.col(f"{mark}.score") >= least)).drop(mark)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``."""
    return language_id(table(spark, sf_dir, "documents"))
