"""Token ids in binary files: patched frame-of-reference blocks.

Layout of a segment (little-endian), the payload of one file row:

    header   u32 magic, u32 ids, u32 documents, u32 blocks
    index    u32 per block: where the block starts, from the segment's start
    lengths  u32 per document: its ids, the end id included
    blocks   u32 minimum, u8 width, u8 0, u16 exceptions, then
             the packed ids (``BLOCK`` differences of ``width`` bits in 64-bit
             words), then per exception u16 place and u32 difference

A block holds ``BLOCK`` ids (the last one of a segment is padded with its
minimum). The width is that of the ``PERCENTILE`` smallest differences to the
minimum; larger differences are exceptions: their packed bits are zero and
the list has them in full. The index gives access to any block alone.

Segments are written by Spark as rows of Parquet files in ascending doc_id
order (``part``, ``segment``), so that a lost task leaves nothing behind and
any store that Spark can write to will do.
"""

from __future__ import annotations

import functools
import itertools
import operator
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import shuffle_width, table

MAGIC = 0x31464F50
BLOCK = 512
PERCENTILE = 0.9
#: Ids of a segment, about (a document stays whole).
SEGMENT = 1 << 20
END = 0
#: Different words whose ids a worker remembers, twice (new ones and older ones).
REMEMBERED = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------- packing

def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) values below 2**width -> (blocks, BLOCK * width / 64) words."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T).astype(np.uint64)
    out = np.zeros((width, lanes.shape[1]), dtype=np.uint64)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        out[word] |= lanes[j] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).reshape(len(values), -1)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The reverse: (blocks, words) -> (blocks, BLOCK) values."""
    rows = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.empty((64, rows.shape[1]), dtype=np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(64):
        word, shift = divmod(j * width, 64)
        v = rows[word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (rows[word + 1] << np.uint64(64 - shift))
        out[j] = v & mask
    return np.ascontiguousarray(out.T).reshape(len(words), BLOCK)


def _widths(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each block the least width that holds the percentile's share of its
    values, and how many values are larger."""
    spare = BLOCK - 1 - min(BLOCK - 1, int(PERCENTILE * BLOCK))
    largest = rows.max(axis=1) if len(rows) else np.zeros(0, np.uint32)
    widths = np.frexp(largest.astype(np.float64))[1].astype(np.int64)
    counts = np.zeros(len(rows), dtype=np.int64)
    open_ = np.flatnonzero(widths)
    while len(open_):  # a bit less as long as few enough values don't fit
        limit = (np.uint64(1) << (widths[open_] - 1).astype(np.uint64)).astype(np.uint32)
        beyond = np.count_nonzero(rows[open_] >= limit[:, None], axis=1)
        fits = beyond <= spare
        open_, beyond = open_[fits], beyond[fits]
        widths[open_] -= 1
        counts[open_] = beyond
        open_ = open_[widths[open_] > 0]
    return widths, counts


def write_segment(ids: np.ndarray, lengths: np.ndarray) -> bytes:
    """The ids of consecutive documents -> a segment."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, dtype=np.uint32)
    padded[:n] = ids
    if n % BLOCK:
        padded[n:] = padded[(blocks - 1) * BLOCK:n].min()
    rows = padded.reshape(blocks, BLOCK)
    low = rows.min(axis=1) if blocks else np.zeros(0, np.uint32)
    rows = rows - low[:, None]
    widths, counts = _widths(rows)
    over = rows > ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    packed = rows.copy()
    packed[over] = 0
    sizes = 8 + widths * (BLOCK // 8) + counts * 6
    start = 16 + 4 * blocks + 4 * len(lengths)
    index = start + np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(index[-1]), dtype=np.uint8)
    out[:16] = np.array([MAGIC, n, len(lengths), blocks], dtype="<u4").view(np.uint8)
    out[16:16 + 4 * blocks] = index[:-1].astype("<u4").view(np.uint8)
    out[16 + 4 * blocks:start] = np.asarray(lengths).astype("<u4").view(np.uint8)
    for width in np.unique(widths):
        which = np.flatnonzero(widths == width)
        head = np.zeros((len(which), 8), dtype=np.uint8)
        head[:, :4] = low[which].astype("<u4").view(np.uint8).reshape(-1, 4)
        head[:, 4] = width
        head[:, 6:] = counts[which].astype("<u2").view(np.uint8).reshape(-1, 2)
        body = head
        if width:
            body = np.concatenate([head, _pack(packed[which], int(width)).astype("<u8").view(np.uint8)], axis=1)
        out[index[which][:, None] + np.arange(body.shape[1])] = body
    block, place = np.nonzero(over)
    if len(block):
        entry = np.zeros((len(block), 6), dtype=np.uint8)
        entry[:, :2] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
        entry[:, 2:] = rows[block, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        rank = np.arange(len(block)) - np.concatenate([[0], np.cumsum(counts)])[block]
        to = index[block] + 8 + widths[block] * (BLOCK // 8) + rank * 6
        out[to[:, None] + np.arange(6)] = entry
    return out.tobytes()


def read_segment(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A segment -> the ids and the documents' lengths."""
    data = np.frombuffer(raw, dtype=np.uint8)
    magic, n, documents, blocks = data[:16].view("<u4").tolist()
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    index = data[16:16 + 4 * blocks].view("<u4").astype(np.int64)
    lengths = data[16 + 4 * blocks:16 + 4 * blocks + 4 * documents].view("<u4").astype(np.int64)
    return read_blocks(data, index)[:n], lengths


def read_blocks(data: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The ids of the blocks that start at ``index``."""
    if not len(index):
        return np.zeros(0, dtype=np.uint32)
    head = data[index[:, None] + np.arange(8)]
    low = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0].astype(np.int64)
    widths = head[:, 4].astype(np.int64)
    counts = np.ascontiguousarray(head[:, 6:]).view("<u2")[:, 0].astype(np.int64)
    rows = np.zeros((len(index), BLOCK), dtype=np.int64)
    for width in np.unique(widths[widths > 0]):
        which = np.flatnonzero(widths == width)
        words = data[index[which][:, None] + 8 + np.arange(width * (BLOCK // 8))]
        rows[which] = _unpack(np.ascontiguousarray(words).view("<u8"), int(width)).astype(np.int64)
    block = np.repeat(np.arange(len(index)), counts)
    if len(block):
        rank = np.arange(len(block)) - np.concatenate([[0], np.cumsum(counts)])[block]
        entry = data[(index[block] + 8 + widths[block] * (BLOCK // 8) + rank * 6)[:, None] + np.arange(6)]
        place = np.ascontiguousarray(entry[:, :2]).view("<u2")[:, 0]
        rows[block, place] = np.ascontiguousarray(entry[:, 2:]).view("<u4")[:, 0]
    rows += low[:, None]
    return rows.ravel().astype(np.uint32)


# ------------------------------------------------------------------ encoding

_token_id = operator.attrgetter("id")


class Encoder:
    """Ids of whole texts by the tokenizers library, remembering its answers.

    The tokenizer never joins a character that is not white space with white
    space behind it, so a text may be cut there and the parts encoded apart:
    at blanks and line ends, and anywhere else in the rare text that has
    white space before a blank. The library encodes each different part that
    is not remembered; the texts' ids are then gathered by part.

    A part of letters alone (and a blank in front) is one word to the library's
    pre-tokenizer, so its model encodes it at once. Which characters are such
    letters, and how the model spells them, is asked of the pre-tokenizer.

    ``added``: names of added tokens in a text ("<|endoftext|>") become these
    tokens' ids, as the library does by default, and texts that hold one are
    encoded whole by it. Otherwise such names are ordinary text.
    """

    _cut = re.compile(r"(?<=\S)(?=\s)")
    _marks = ".,;:!?*#%&$+=-_()[]{}<>/|\""
    _LETTERS = 0x530  #: Latin, Greek and Cyrillic; others are encoded by the whole library

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self._batch = functools.partial(self.tokenizer.encode_batch_fast, add_special_tokens=False)
        self.line_end, = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._end = np.array([self.line_end], dtype="<u4").tobytes()
        self._spelt = self._letters()
        self._word = re.compile(f"\n?[{re.escape(''.join(map(chr, self._spelt)))}]+") if self._spelt else None
        self.words: dict[str, bytes] = {}  # word -> ids of it with a blank (or its own line end) in front
        self.older: dict[str, bytes] = {}  # what was known before; used words move on
        self.tails: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}  # first words: nothing in front of them

    def _letters(self) -> dict[int, str]:
        """Code point -> spelling, of the characters that stay in a word's one
        piece; empty if words of letters cannot be told from the model alone."""
        named = self.tokenizer.get_added_tokens_decoder().values()
        pieces = self.tokenizer.pre_tokenizer and self.tokenizer.pre_tokenizer.pre_tokenize_str
        if self.tokenizer.normalizer or not pieces or not all(t.special for t in named):
            return {}
        spaced = [p for p, _ in pieces(" a")]
        if len(spaced) != 1 or spaced[0][1:] != "a":
            return {}
        self._blank = spaced[0][0]
        out = {}
        for c in range(self._LETTERS):
            found = [p for p, _ in pieces(f"a{chr(c)}a")]
            if chr(c).isalpha() and len(found) == 1 and found[0][0] == found[0][-1] == "a":
                out[c] = found[0][1:-1]
        # ASCII letters are not respelt, so that words of them need no translation.
        ascii_too = all(out.get(c) == chr(c) for c in range(128) if chr(c).isalpha())
        return out if ascii_too and len(pieces(" " + "".join(map(chr, out)))) == 1 else {}

    def _encode(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for a in range(0, len(parts), 20_000):
            ids = [e.ids for e in self._batch(parts[a:a + 20_000])]
            out += _split(np.fromiter(itertools.chain.from_iterable(ids), dtype="<u4"), list(map(len, ids)))
        return out

    def _encode_words(self, words: list[str], blank: str) -> list[bytes]:
        """As ``_encode`` of ``blank + word``, many at once as lines of one text:
        a line end between two of them is a token of its own."""
        out: list[bytes] = []
        for a in range(0, len(words), 100 * 200):
            lines = [words[i:i + 100] for i in range(a, min(len(words), a + 100 * 200), 100)]
            for own, e in zip(lines, self._batch([blank + f"\n{blank}".join(own) for own in lines])):
                ids = np.array(e.ids, dtype="<u4")
                ends = np.flatnonzero(ids == self.line_end)
                if len(ends) == len(own) - 1:
                    raw = ids.tobytes()
                    at = [-1, *ends.tolist(), len(ids)]
                    out += [raw[4 * x + 4:4 * y] for x, y in zip(at, at[1:])]
                else:
                    out += self._encode([blank + w for w in own])
        return out

    def _encode_letters(self, words: list[str]) -> list[bytes]:
        """As ``_encode_words`` of words of letters, by the library's model."""
        tokenize, blank, spell = self.tokenizer.model.tokenize, self._blank, self._spelt
        ids: list[int] = []
        ends = [0]
        for w in words:
            spelt = w if w.isascii() else w.translate(spell)
            ids += map(_token_id, tokenize(blank + spelt if w[0] != "\n" else spelt[1:]))
            ends.append(len(ids))
        raw = np.array(ids, dtype="<u4").tobytes()
        return [self._end + raw[4 * a:4 * b] if w[0] == "\n" else raw[4 * a:4 * b]
                for w, a, b in zip(words, ends, ends[1:])]

    def _learn(self, new: list[str]) -> None:
        # Marks behind a letter are tokens of their own: fewer different words.
        whole, ended, stems = [], [], []
        marks = self._marks
        for w in new:
            if w[-1] in marks:
                stem = w.rstrip(marks)
                if stem and stem[-1].isalpha():
                    ended.append(w)
                    stems.append(stem)
                    continue
            whole.append(w)
        words, known = self.words, self.older
        whole = [w for w in {*whole, *stems} if w not in words]
        if known:
            words.update((w, known[w]) for w in whole if w in known)
            whole = [w for w in whole if w not in known]
        letters = list(filter(self._word.fullmatch, whole)) if self._word else []
        others = list(set(whole).difference(letters))
        words.update(zip(letters, self._encode_letters(letters)))
        # White space at a word's start could join the line end in front of it.
        line = [w for w in others if w[0] == "\n" and not w[1:2].isspace()]
        inside = [w for w in others if not w[0].isspace()]
        odd = [w for w in others if w[0].isspace() and (w[0] != "\n" or w[1:2].isspace())]
        words.update(zip(odd, self._encode([w if w[0] == "\n" else f" {w}" for w in odd])))
        words.update(zip(inside, self._encode_words(inside, " ")))
        end = self._end
        words.update((w, end + ids) for w, ids in zip(line, self._encode_words([w[1:] for w in line], "")) if len(w) > 1)
        tails = [w[len(stem):] for w, stem in zip(ended, stems)]
        fresh = list(set(tails).difference(self.tails))
        self.tails.update(zip(fresh, self._encode(fresh)))
        words.update(zip(ended, map(operator.add, map(words.__getitem__, stems), map(self.tails.__getitem__, tails))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        ids, lengths = self.encode_array(pa.array(texts, pa.large_string()))
        return _split(ids.astype("<u4", copy=False), lengths.tolist())

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind each other, and each text's number of ids (a null text is empty)."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        named = np.zeros(len(texts), dtype=bool)
        for name in self.added:
            named |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(named), pa.scalar("", pa.large_string()), texts) if named.any() else texts
        split = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        bounds = split.offsets.to_numpy().astype(np.int64)
        first = bounds[:-1]
        coded = split.flatten().dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        unit = coded.indices.to_numpy().astype(np.int64)

        # First words: nothing in front of them.
        firsts, which = np.unique(unit[first], return_inverse=True)
        heads = [parts[i] for i in firsts.tolist()]
        unit[first] = len(parts) + which
        inside = np.bincount(unit, minlength=len(parts))[:len(parts)] > 0
        # White space before a blank: the text may not be cut there.
        usable = inside & np.fromiter((w != "" and not w[-1].isspace() for w in parts), dtype=bool, count=len(parts))
        sought = list(itertools.compress(parts, usable.tolist()))
        new = [w for w in sought if w not in self.words]
        if len(self.words) + len(new) > REMEMBERED:
            self.older, self.words, self.tails, self.heads = self.words, {}, {}, {}
            new = sought
        self._learn(new)
        fresh = [h for h in heads if h not in self.heads]
        self.heads.update(zip(fresh, self._encode(fresh)))

        words = self.words
        ids = [words[w] if u else b"" for w, u in zip(parts, usable.tolist())] + [self.heads[h] for h in heads]
        uncut = np.concatenate([inside & ~usable, np.zeros(len(heads), dtype=bool)])
        whole = np.logical_or.reduceat(uncut[unit], first)
        odd = np.array([not h or h[-1].isspace() for h in heads])
        whole |= odd[which] & (np.diff(bounds) > 1)
        for i in np.flatnonzero(whole | named).tolist():
            text = texts[i].as_py()
            unit[bounds[i]:bounds[i + 1]] = len(ids)
            ids.append(b"")
            unit[bounds[i]] = len(ids)
            ids.append(b"".join(self._encode([text] if named[i] else self._cut.split(text))))

        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        size = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4
        start = (np.cumsum(size) - size)[unit]
        size = size[unit]
        start -= np.cumsum(size) - size
        return flat[np.repeat(start, size) + np.arange(size.sum())], np.add.reduceat(size, first)


def _split(ids: np.ndarray, sizes: list[int]) -> list[bytes]:
    raw = ids.tobytes()
    ends = list(itertools.accumulate(sizes, initial=0))
    return [raw[4 * x:4 * y] for x, y in zip(ends, ends[1:])]


@functools.cache
def _encoder(path: str, added: bool) -> Encoder:
    return Encoder(path, added)


def _segments(path: str, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, added)
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        docs: list[int | None] = []
        held = number = before = 0
        part = None

        def done() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "segment": pa.array([number], pa.int32()),
                "before": pa.array([before], pa.int64()), "n_ids": pa.array([len(flat)], pa.int64()),
                "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "payload": pa.array([write_segment(flat, np.concatenate(lengths))], pa.binary())})
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            part = batch.column("part")[0].as_py()
            own = batch.column("doc_id").to_pylist()
            new, length = encoder.encode_array(batch.column("text"))
            new = np.insert(new, np.cumsum(length), END)
            length += 1
            ends = np.concatenate([[0], np.cumsum(length)])
            a = 0
            while a < rows:  # up to the document that fills the segment
                b = min(rows, int(np.searchsorted(ends, ends[a] + SEGMENT - held)))
                ids.append(new[ends[a]:ends[b]])
                lengths.append(length[a:b])
                docs += own[a:b]
                held += int(ends[b] - ends[a])
                a = b
                if held >= SEGMENT:
                    yield done()
                    ids, lengths, docs, held, number, before = [], [], [], 0, number + 1, before + held
        if docs:
            yield done()
    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str | None = None, added: bool = False) -> None:
    """Encode the texts of ``docs`` (doc_id, text) and write them to ``path``.

    Ascending doc_id (NULL first); rows that share a doc_id come in the order
    of their text's hash. A NULL text is empty. Each document ends with id 0.
    ``added``: names of added tokens become their ids (see ``Encoder``).
    """
    spark = docs.sparkSession
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
               .withColumn("h", F.xxhash64("text"))
               .repartitionByRange(shuffle_width(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")
               .withColumn("part", F.spark_partition_id()).select("part", "doc_id", "text"))
    schema = "part int, segment int, before long, n_ids long, doc_ids array<long>, payload binary"
    (ordered.mapInArrow(_segments(tokenizer or default_tokenizer(), added), schema)
     .write.option("compression", "none").parquet(path))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids, lengths = read_segment(row["payload"])
            raw = ids.astype("<u4").tobytes()
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "start": pa.array(row["before"] + ends[:-1], pa.int64()),
                "n_tokens": pa.array(lengths, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends, ends[1:])], pa.int64())})


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files."""
    segments = spark.read.parquet(path)
    # One row per writing task, of which there are as many as the shuffle is
    # wide, whatever the ids: small enough to send to every task.
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("earlier"))
    return (segments.join(F.broadcast(earlier), "part")
            .select("doc_ids", "payload", (F.col("before") + F.col("earlier")).alias("before"))
            .mapInArrow(_documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op8_token_files(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` written as ids, and read back from the files."""
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, sf_dir, "documents"), path, added=True)
    return read_ids(spark, path)
