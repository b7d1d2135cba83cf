"""Bootstrap dump: one JSON-lines file (or folder) per entity."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import META, load_rows, parse, write_load
from ..session import path_exists

log = logging.getLogger(__name__)


def bootstrap_texts(spark: SparkSession, directory: str,
                    entities=("posts", "comments", "users")) -> dict[str, DataFrame]:
    """Lines of ``<dir>/<entity>.json`` per entity, in the routed layout.
    A missing file is logged and skipped."""
    out = {}
    for entity in entities:
        path = f"{directory.rstrip('/')}/{entity}.json"
        if not path_exists(spark, path):
            log.warning("bootstrap: %s not found, skipping %s", path, entity)
            continue
        lines = spark.read.text(path).where(F.trim("value") != "")
        out[entity] = lines.select(F.lit(entity).alias("data_type"), F.col("value").alias("_raw"),
                                   *(F.lit(None).cast(t).alias(c) for c, t in
                                     zip(META, ["string", "string", "int", "bigint", "timestamp"])))
    return out


def bootstrap_load(spark: SparkSession, directory: str,
                   entities=("posts", "comments", "users")) -> dict[str, DataFrame]:
    """``<dir>/<entity>.json`` → parsed rows (with ``_status``) per entity.

    Lines are read as text and decoded with the fixed schema, so a bad line
    is classified (and later quarantined) instead of failing the read or
    turning into an all-NULL row.
    """
    return {e: parse(t, e, keep=["data_type"]) for e, t in bootstrap_texts(spark, directory, entities).items()}


def ingest_bootstrap(spark: SparkSession, directory: str, base: str,
                     entities=("posts", "comments", "users"), load: str = "bootstrap") -> None:
    """The dump into the store, as one load: running it again replaces it."""
    texts = bootstrap_texts(spark, directory, entities)
    if texts:
        every = None
        for t in texts.values():
            every = t if every is None else every.unionByName(t)
        write_load(load_rows(every, load, entities), base, load)
