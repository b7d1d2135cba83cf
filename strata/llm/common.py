"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_utc, remove_path, scratch_path


#: Bytes of rows that a Python worker gets at once. Texts are held a few times
#: over while they are worked on, so this bounds a worker's memory.
BATCH_BYTES = 2 << 20


def prepared(query):
    """Wrap a query or stage: its Python workers can import this package from
    where the driver has it (on a cluster: installed, or the same path), get
    small batches, and the session works in UTC. These settings stay with the
    session, since results are read after the query has returned."""
    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        home = str(Path(__file__).resolve().parents[2])
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if home not in known.split(":"):
            spark.sparkContext.environment["PYTHONPATH"] = f"{home}:{known}".rstrip(":")
        ensure_utc(spark)
        size = "spark.sql.execution.arrow.maxBytesPerBatch"
        if not 0 < int(spark.conf.get(size).rstrip("b")) <= BATCH_BYTES:
            spark.conf.set(size, str(BATCH_BYTES))
        return query(spark, *args)
    return run


#: Folders of the innermost open ``scratch``, after those around it.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("strata_scratch", default=())


@contextmanager
def scratch(spark: SparkSession):
    """The tables that are materialised inside belong to this block and are
    removed at its end, but for ``lasting`` ones. Other runs' tables stay."""
    own: list[str] = []
    token = _open.set((*_open.get(), own))
    try:
        yield
    finally:
        _open.reset(token)
        for path in own:
            remove_path(spark, path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write a step's rows to the shared scratch folder and read them back.

    This cuts the lineage: a lost executor costs the tasks it was running,
    not the steps before, and row ids given before the write stay fixed. The
    innermost ``scratch`` block removes the table; a ``lasting`` one, which
    the block's result still reads, belongs to the block around it, if any.
    """
    path = scratch_path(df.sparkSession, name)
    owners = _open.get()[:-1] if lasting else _open.get()
    if owners:
        owners[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> list[Column]:
    """128-bit identity of a text, as two longs (null text: its own value)."""
    return [F.xxhash64(text, F.lit(11)), F.xxhash64(F.lit(29), text)]


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Split batches that are sorted by ``keys`` into one frame per key.

    A group may span batches; only the open group is held, so memory follows
    the largest group, which the callers bound before they shuffle.
    """
    held: list[pd.DataFrame] = []
    last = None
    for pdf in batches:
        if not len(pdf):
            continue
        change = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
        cuts = [i for i in change.nonzero()[0] if i]
        if held and tuple(pdf[keys].iloc[0]) != last:
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
            held = []
        edges = [0, *cuts, len(pdf)]
        for a, b in zip(edges, edges[1:]):
            if a:
                yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
                held = []
            held.append(pdf.iloc[a:b].reset_index(drop=True))
        last = tuple(pdf[keys].iloc[-1])
    if held:
        yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
