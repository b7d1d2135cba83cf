"""SentencePiece encoding and decoding with a relational lattice.

A text is encoded to the pieces whose scores sum highest (the Viterbi path),
as SentencePiece's unigram model does it, with byte fallback. The score of a
piece is the model file's.

A text is cut into units wherever no piece of the vocabulary covers both
neighbouring characters: no path crosses such a place, so the best path of a
text is the best paths of its units one after the other, and each different
unit needs encoding once:

1. Texts are dealt into blocks of at most ``BLOCK`` characters where they lie;
   each block sends its different units.
2. The lattice: units are exploded to all substrings of up to the longest
   piece's length and joined with the piece table (an equi-join; the table is
   broadcast, as its size is the vocabulary's). What joins are the edges;
   they are grouped by unit, and ``aggregate`` folds them to the best path.
3. The encoded units go back to the blocks that sent them, sorted in front of
   the block's texts (packed and compressed for the shuffle), and the texts
   are written as ids.

Units of over ``LONGEST`` characters, in which a row per substring would be
too much for one group, are encoded by the same recurrence where their text
lies. So is a unit that its block did not send, should a lost task have dealt
texts differently when it ran again: the result does not depend on the blocks.
"""

from __future__ import annotations

import functools
import itertools
import re
import struct
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shuffle_width, table
from .text import code_points

SPACE = "▁"
#: Characters of the texts of one block.
BLOCK = 48_000_000
#: Characters of a unit that goes through the relational lattice.
LONGEST = 48
#: Words of several units whose ids a task remembers; others are put together again.
REMEMBERED = 100_000
#: Words that are cut into units at once.
SLICE = 20_000
#: Units of a task whose edges are grouped in memory (a few KB each) before it sorts.
GROUPS = 20_000
#: What an unknown character costs below the worst piece, as in SentencePiece.
UNKNOWN_PENALTY = 10.0


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: normal pieces with scores, byte pieces, text of every id."""

    normal: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    texts: tuple[bytes, ...]
    longest: int
    unknown_score: float
    pairs: frozenset[str]

    @classmethod
    def load(cls, path: str) -> Pieces:
        """The model file's pieces; of the normal ones, those that a best path can hold.

        A piece whose text has a better path of other pieces is on no best path,
        so it is left out of the table (its id still decodes)."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal, byte_ids, texts = {}, [0] * 256, []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                texts.append(b"")
            else:
                normal[piece] = (i, float(model.get_score(i)))
                texts.append(piece.replace(SPACE, " ").encode())
        worst = min(s for _, s in normal.values())
        normal = {p: v for p, v in normal.items() if len(p) == 1 or _best_of_others(p, normal) <= v[1]}
        return cls(normal, tuple(byte_ids), tuple(texts), max(map(len, normal)), worst - UNKNOWN_PENALTY,
                   frozenset(p[i:i + 2] for p in normal for i in range(len(p) - 1)))

    def words(self, text: str) -> list[str]:
        """The normalised text, cut before every run of blanks and at line ends
        where no piece goes across."""
        return self._word.findall(SPACE + text.replace(" ", SPACE)) if text else []

    @functools.cached_property
    def _word(self) -> re.Pattern:
        free = "" if any("\n" in p for p in self.pairs) else "\n"
        if any(p[1] == SPACE != p[0] for p in self.pairs):
            return re.compile(r".+", re.S)
        alone = f"{free}|" if free else ""
        return re.compile(f"{alone}{SPACE}*[^{SPACE}{free}]+|{SPACE}+")

    @functools.cached_property
    def _pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        near = np.zeros(_NEAR * _NEAR, dtype=bool)
        codes = np.array(sorted(ord(p[0]) << 21 | ord(p[1]) for p in self.pairs), dtype=np.int64)
        a, b = codes >> 21, codes & 0x1FFFFF
        both = (a < _NEAR) & (b < _NEAR)
        near[a[both] * _NEAR + b[both]] = True
        return near, codes

    def units_of(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """The words cut wherever no piece covers both neighbours: all units in
        order, and the number of each word's first (one more at the end)."""
        text = "".join(words)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        if not text:
            return [], np.zeros(len(words) + 1, dtype=np.int64)
        near, codes = self._pair_table
        cp = code_points(text).astype(np.int64)
        a, b = cp[:-1], cp[1:]
        far = (a >= _NEAR) | (b >= _NEAR)
        inside = near[np.where(far, 0, a * _NEAR + b)]
        if far.any():
            inside[far] = np.isin(a[far] << 21 | b[far], codes)
        cut = ~inside
        cut[ends[:-1] - 1] = True
        at = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(cp)]])
        bounds = at.tolist()
        return ([text[x:y] for x, y in zip(bounds, bounds[1:])],
                np.concatenate([[0], np.searchsorted(at, ends)]))

    def units(self, word: str) -> list[str]:
        return self.units_of([word])[0]

    def quick_words(self, text: str) -> list[str] | None:
        """The words of an ordinary text by a plain split; NULL if it has blanks
        in a row or at an end, or begins with a line end. A word stands for ``marked(word)``."""
        if self._alone and text and text[0] not in " \n" and text[-1] != " " and not (
                "  " in text or " \n" in text or SPACE in text):
            return text.replace("\n", " \n").split(" ")
        return None

    @functools.cached_property
    def _alone(self) -> bool:
        """Whether no piece goes across a line end or a blank behind a character."""
        return not any("\n" in p or p[1] == SPACE != p[0] for p in self.pairs)

    def best_path(self, unit: str) -> list[int]:
        """The ids of the best path; of equal paths, that whose last piece is longest."""
        n = len(unit)
        score, back = [0.0] + [-np.inf] * n, [(0, 0)] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                found = self.normal.get(unit[start:end])
                if found is None and end - start == 1:
                    found = (-1, self.unknown_score)
                if found and score[start] + found[1] > score[end]:
                    score[end], back[end] = score[start] + found[1], (start, found[0])
        ids: list[list[int]] = []
        while n:
            start, i = back[n]
            ids.append([i] if i >= 0 else [self.byte_ids[b] for b in unit[start:n].encode("utf-8", "surrogatepass")])
            n = start
        return [i for part in reversed(ids) for i in part]

    def decode(self, ids) -> str:
        raw = b"".join(map(self.texts.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


#: Characters whose pairs are looked up in a plain table.
_NEAR = 1024


def _best_of_others(piece: str, normal: dict[str, tuple[int, float]]) -> float:
    """The best score of the piece's text by other pieces."""
    n = len(piece)
    score = [0.0] + [-np.inf] * n
    for end in range(1, n + 1):
        for start in range(end):
            found = normal.get(piece[start:end]) if end - start < n else None
            if found:
                score[end] = max(score[end], score[start] + found[1])
    return score[n]


def _marked(word: str) -> str:
    return word if word[0] == "\n" else SPACE + word


def _block(number: int, held: int) -> int:
    """Blocks count up within a partition, so that one never spans two."""
    return number * (1 << 20) + held // BLOCK


def _forget() -> None:
    """Workers are used again by later stages: drop the tables that the operators
    of earlier ones have remembered (hashes of all characters, powers)."""
    for name in ("text", "winnow"):
        module = sys.modules.get(f"{__package__}.{name}")
        for value in list(vars(module).values()) if module else []:
            if isinstance(value, functools._lru_cache_wrapper):
                value.cache_clear()


def _units_of_blocks(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        pieces: Pieces = shared.value
        held, now = 0, None
        quick: set[str] = set()
        words: set[str] = set()

        def sent() -> Iterator[pa.RecordBatch]:
            units: set[str] = set()
            every = itertools.chain(map(_marked, quick), words)
            while part := list(itertools.islice(every, SLICE)):
                units.update(u for u in pieces.units_of(part)[0] if len(u) <= LONGEST)
            while units:
                part = [units.pop() for _ in range(min(SLICE, len(units)))]
                yield pa.RecordBatch.from_pydict({"unit": pa.array(part, pa.string()),
                                                  "block": pa.array([now] * len(part), pa.int64())})
        for batch in batches:
            for text, number in zip(batch.column("text").to_pylist(), batch.column("_strata_partition").to_pylist()):
                block = _block(number, held)
                if block != now:
                    if quick or words:
                        yield from sent()
                    quick, words, now = set(), set(), block
                held += len(text or "")
                own = pieces.quick_words(text or "")
                if own is None:
                    words.update(pieces.words(text or ""))
                else:
                    quick.update(own)
        if quick or words:
            yield from sent()
    return run


def _packed_texts(shared, names: list[str]):
    """Rows -> (block, order, blob): consecutive rows of a block, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = order = 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            number = batch.column("_strata_partition")[0].as_py() if len(batch) else 0
            batch = batch.select(names)
            sizes = [len(t or "") for t in batch.column("text").to_pylist()]
            begin = i = 0
            while begin < len(sizes):
                block, room, i = _block(number, held), 500_000, begin
                while i < len(sizes) and room > 0 and _block(number, held) == block:
                    held += sizes[i]
                    room -= sizes[i] + 100
                    i += 1
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(begin, i - begin))
                order += 1
                yield pa.RecordBatch.from_pydict({"block": [block], "place": pa.array([order], pa.int64()),
                                                  "blob": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
                begin = i
    return run


def _packed_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(unit, blocks, ids) -> one blob per block and batch; place 0 is before any text."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        blocks = batch.column("blocks")
        number = blocks.flatten().to_numpy()
        row = np.repeat(np.arange(len(batch)), np.diff(blocks.offsets.to_numpy()))
        order = np.argsort(number, kind="stable")
        number, row = number[order], row[order]
        coded = batch.select(["unit", "ids"])
        edges = [0, *(np.flatnonzero(np.diff(number)) + 1), len(number)]
        rows = []
        for a, b in zip(edges, edges[1:]):
            if a == b:
                continue
            part = coded.take(pa.array(row[a:b]))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_batch(part)
            rows.append((number[a], 0, sink.getvalue().to_pybytes()))
        if rows:
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([r[0] for r in rows], pa.int64()), "place": pa.array([r[1] for r in rows], pa.int64()),
                "blob": pa.array([r[2] for r in rows], pa.binary())})


def _encode_blocks(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        pieces: Pieces = shared.value
        now = coder = None
        for batch in batches:
            for block, place, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if block != now:
                    now, coder = block, Coder(pieces)
                rows = pa.ipc.open_stream(blob).read_all()
                if not place:
                    ids = rows.column("ids").combine_chunks()
                    flat = ids.flatten().to_numpy().astype("<i4").tobytes()
                    at = ids.offsets.to_numpy() * 4
                    at = at - at[0]
                    coder.learn(rows.column("unit").to_pylist(), [flat[a:b] for a, b in zip(at.tolist(), at[1:].tolist())])
                    continue
                coded, same = coder.encode([t or "" for t in rows.column("text").to_pylist()])
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                flat = np.frombuffer(b"".join(coded), dtype="<i4")
                out = {n: rows.column(n).combine_chunks() for n in names}
                out |= {"_strata_ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                        "_strata_same": pa.array(same, pa.bool_())}
                yield pa.RecordBatch.from_pydict(out)
    return run


class Coder:
    """Writes texts as ids, from the ids of their units."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.units: dict[str, bytes] = {}  # the block's encoded units that are no words
        self.quick: dict[str, bytes] = {}  # words by ``quick_words`` -> ids
        self.joined: list[str] = []  # those of several units
        self.wrong: set[str] = set()  # those that do not decode to themselves

    def learn(self, units: list[str], codes: list[bytes]) -> None:
        """Encoded units; one that is a whole word with its blank is kept as that word."""
        words, own = [], []
        for u, c in zip(units, codes):
            if u[0] == SPACE and len(u) > 1 and u[1] != "\n" and SPACE not in u[1:]:
                words.append(u[1:])
                own.append(c)
            else:
                self.units[u] = c
        self._keep(words, own)

    def _keep(self, words: list[str], codes: list[bytes]) -> None:
        self.quick.update(zip(words, codes))
        texts = self.pieces.texts
        for w, c in zip(words, codes):
            own = texts[c[0] | c[1] << 8 | c[2] << 16] if len(c) == 4 else b"".join(map(texts.__getitem__, memoryview(c).cast("i")))
            if own != _marked(w).replace(SPACE, " ").encode("utf-8", "surrogatepass"):
                self.wrong.add(w)

    def _code(self, unit: str) -> bytes:
        found = self.units.get(unit)
        if found is None and unit[0] == SPACE and unit[1:2] != "\n":
            found = self.quick.get(unit[1:])
        if found is None:
            ids = self.pieces.best_path(unit)
            found = self.units[unit] = struct.pack(f"<{len(ids)}i", *ids)
        return found

    def _codes(self, words: list[str]) -> list[bytes]:
        if len(words) > SLICE:
            return [c for a in range(0, len(words), SLICE) for c in self._codes(words[a:a + SLICE])]
        units, first = self.pieces.units_of(words)
        codes = list(map(self._code, units))
        at = first.tolist()
        return [codes[a] if b - a == 1 else b"".join(codes[a:b]) for a, b in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """The ids of each text, and whether they decode to it. Decoding goes
        id by id, so a text comes back if each of its words does."""
        pieces = self.pieces
        split = [pieces.quick_words(t) for t in texts]
        new = list(set().union(*(s for s in split if s is not None)).difference(self.quick))
        if len(self.joined) + len(new) > REMEMBERED:
            for w in self.joined:
                del self.quick[w]
            self.joined = []
            new = list(set().union(*(s for s in split if s is not None)).difference(self.quick))
        self._keep(new, self._codes([_marked(w) for w in new]))
        self.joined += new
        out, same = [], []
        for text, words in zip(texts, split):
            if words is None:
                code = b"".join(self._codes(pieces.words(text)))
                same.append(pieces.decode(memoryview(code).cast("i")) == text)
            else:
                code = b"".join(map(self.quick.__getitem__, words))
                same.append(self.wrong.isdisjoint(words) if self.wrong else True)
            out.append(code)
        return out, same


def piece_table(spark: SparkSession, pieces: Pieces) -> DataFrame:
    """(piece, id, score): as many rows as the vocabulary."""
    rows = pd.DataFrame([(p, i, s) for p, (i, s) in pieces.normal.items()], columns=["piece", "id", "score"])
    return spark.createDataFrame(rows, "piece string, id int, score double")


def _fold(edges: Column) -> Column:
    """Edges sorted by (end, start) -> the ids of the best path.

    The state holds, for each position reached, the best score and path to it.
    The first edge of a position appends it, later ones may replace it.
    """
    kind = "array<struct<score:double,ids:array<int>>>"

    def step(state: Column, e: Column) -> Column:
        origin = F.element_at(state, e["start"] + 1)
        score = origin["score"] + e["score"]
        best = F.struct(score.alias("score"), F.concat(origin["ids"], F.array(e["id"])).alias("ids"))
        return (F.when(F.size(state) == e["end"], F.concat(state, F.array(best)))
                .when(score > F.element_at(state, -1)["score"],
                      F.concat(F.slice(state, F.lit(1), F.size(state) - 1), F.array(best)))
                .otherwise(state))
    first = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids"))).cast(kind)
    return F.aggregate(edges, first, step, lambda s: F.element_at(s, -1)["ids"])


def lattice(units: DataFrame, pieces: Pieces, carry: str) -> DataFrame:
    """(unit, ``carry``), units different -> (unit, carry, ids).

    ``carry`` rides on the edge at the start of each unit only.
    """
    table_ = F.broadcast(piece_table(units.sparkSession, pieces))  # as large as the vocabulary, whatever the texts
    spots = units.select("unit", carry, F.explode(F.sequence(F.lit(0), F.char_length("unit") - 1)).alias("start"))
    most = F.least(F.lit(pieces.longest), F.char_length("unit") - F.col("start"))
    spans = spots.select("unit", F.when(F.col("start") == 0, F.col(carry)).alias(carry), "start",
                         F.explode(F.sequence(F.lit(1), most)).alias("length"))
    spans = spans.select("unit", F.when(F.col("length") == 1, F.col(carry)).alias(carry), "start",
                         (F.col("start") + F.col("length")).alias("end"),
                         F.substring("unit", F.col("start") + 1, F.col("length")).alias("piece"))
    edges = (spans.join(table_, "piece", "left")
             .where(F.col("id").isNotNull() | (F.col("end") - F.col("start") == 1)))
    # An unknown character's edge carries its place, as a negative id.
    edge = F.struct("end", "start", F.coalesce("id", -1 - F.col("start")).alias("id"),
                    F.coalesce("score", F.lit(pieces.unknown_score)).alias("score"))
    folded = edges.groupBy("unit").agg(
        F.collect_list(edge).alias("edges"), F.first(carry, ignorenulls=True).alias(carry)).select(
            "unit", carry, _fold(F.array_sort("edges")).alias("ids"))
    byte_ids = F.lit(list(pieces.byte_ids))

    def spelt(i: Column) -> Column:
        char = F.hex(F.encode(F.substring(F.col("unit"), -i, F.lit(1)), "utf-8"))
        return F.transform(F.sequence(F.lit(1), F.length(char), F.lit(2)),
                           lambda k: F.element_at(byte_ids, F.conv(F.substring(char, k, F.lit(2)), 16, 10).cast("int") + 1))
    plain = F.flatten(F.transform("ids", lambda i: F.when(i < 0, spelt(i)).otherwise(F.array(i))))
    ids = F.when(F.exists("ids", lambda i: i < 0), plain).otherwise(F.col("ids"))
    return folded.select("unit", carry, ids.alias("ids"))


def encode(docs: DataFrame, model: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` with ids (array<int>) and round_trip (whether decoding
    them gives the text again), beside the columns ``keep`` (all, if not given).

    A NULL or empty text has no ids, and its round trip is right. Any other
    text gets SentencePiece's blank in front. The text's own U+2581 counts as a
    blank, as in SentencePiece, so such a text does not come back. Repeated
    rows each give a row; no rows give none.
    """
    spark = docs.sparkSession
    pieces = Pieces.load(model or default_model())
    shared = spark.sparkContext.broadcast(pieces)
    names = list(docs.columns) if keep is None else list(dict.fromkeys([*keep, "text"]))
    docs = docs.select(*names)
    out = names if keep is None else keep
    # Of the scan's own partitions, so that both passes deal texts to the same blocks.
    numbered = docs.withColumn("_strata_partition", F.spark_partition_id())
    sent = numbered.select("text", "_strata_partition").mapInArrow(_units_of_blocks(shared), "unit string, block long")
    units = sent.groupBy("unit").agg(F.collect_list("block").alias("blocks"))
    # A unit's edges stand together, so grouping them by hash needs no sort.
    spark.conf.set("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", str(GROUPS))
    packed = lattice(units, pieces, "blocks").select("unit", "blocks", "ids").mapInArrow(_packed_units, "block long, place long, blob binary")
    rows = numbered.mapInArrow(_packed_texts(shared, names), "block long, place long, blob binary")
    dealt = (packed.union(rows).repartition(shuffle_width(spark), "block")
             .sortWithinPartitions("block", "place"))
    kept = docs.select(*out).schema
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "_strata_ids array<int>", "_strata_same boolean"])
    return dealt.mapInArrow(_encode_blocks(shared, out), ddl).withColumnsRenamed(
        {"_strata_ids": "ids", "_strata_same": "round_trip"})


def decode(rows: DataFrame, model: str | None = None, ids: str = "ids") -> Column:
    """The text of an id column (NULL: NULL)."""
    shared = rows.sparkSession.sparkContext.broadcast(Pieces.load(model or default_model()))

    @F.pandas_udf("string")
    def text(batch: pd.Series) -> pd.Series:
        return batch.map(lambda x: None if x is None else shared.value.decode(x.tolist()))
    return text(rows[ids])


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """The ids of every text of ``documents``, and whether they decode to it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (encode(docs, keep=["doc_id"])
            .select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "round_trip", "ids"))
