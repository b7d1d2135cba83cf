"""A bitmap of fixed size built in Spark: a Bloom filter's memory.

The filter is a bounded prefilter only: what passes it is joined exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import mix64

#: Bits for each entry, as long as the bitmap stays within ``MOST`` bits (32 MB).
PER_ENTRY = 64
LEAST, MOST = 1 << 16, 1 << 28
#: Bytes of the bitmap that travel as one row.
SLICE = 1 << 13
PROBES = 2


def _positions(keys: np.ndarray, n_bits: int) -> np.ndarray:
    h = mix64(keys.view(np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64(n_bits - 1)
    return np.stack([((h + np.uint64(i) * step) & mask).astype(np.int64) for i in range(PROBES)])


def build(keys: DataFrame) -> np.ndarray:
    """Bitmap (bytes) of a one-column frame of longs; its size has an upper bound."""
    entries = keys.count()
    n_bits = min(MOST, max(LEAST, 1 << (PER_ENTRY * entries - 1).bit_length())) if entries else LEAST
    column = keys.columns[0]

    def place(batches):
        for pdf in batches:
            yield pd.DataFrame({"byte": np.unique(_positions(pdf[column].to_numpy(), n_bits).ravel())})

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        bit = pdf["byte"].to_numpy()
        own = np.zeros(SLICE, dtype=np.uint8)
        np.bitwise_or.at(own, (bit >> 3) % SLICE, (1 << (bit & 7)).astype(np.uint8))
        return pd.DataFrame({"slice": [int(bit[0] >> 3) // SLICE], "bits": [own.tobytes()]})

    slices = (keys.mapInPandas(place, "byte long").distinct()
              .groupBy(F.expr(f"byte div {8 * SLICE}")).applyInPandas(pack, "slice long, bits binary"))
    out = np.zeros(n_bits // 8, dtype=np.uint8)
    for r in slices.collect():
        out[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] = np.frombuffer(r["bits"], np.uint8)
    return out


def contains(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be among the entries (never wrong when it says no)."""
    out = np.ones(len(keys), dtype=bool)
    left = np.arange(len(keys))
    h = mix64(keys.view(np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    mask = np.uint64(8 * len(bitmap) - 1)
    for i in range(PROBES):
        at = ((h[left] + np.uint64(i) * step[left]) & mask).astype(np.int64)
        hit = (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        out[left[~hit]] = False
        left = left[hit]
    return out
