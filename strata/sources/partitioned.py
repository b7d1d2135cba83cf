"""The hour-partitioned master dataset (read side)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import on_dates, parse_day
from ..operators.ingest import MALFORMED, META, OK, RESCUED, parse
from ..schemas import ENTITY_SCHEMAS, PARTITION_COLUMNS
from ..session import path_exists
from ..store import STORED, load_manifest, read_parts


def stored_schema(entity: str) -> T.StructType:
    """Entity fields with the parsed time, then the int partition columns."""
    fields = []
    for f in ENTITY_SCHEMAS[entity].fields:
        fields.append(T.StructField(f.name, T.TimestampType() if f.name == "timestamp" else f.dataType, True))
    fields += [T.StructField(c, T.IntegerType(), True) for c in PARTITION_COLUMNS]
    return T.StructType(fields)


def read_partitioned(spark: SparkSession, base: str, entity: str, fmt: str = "parquet", rescued: bool = False,
                     days: list | None = None, version: int | None = None) -> DataFrame:
    """Read one entity of the store.

    The folders that the store's manifest shows are read (its newest version, or
    ``version``) or, if it has none, a plain table ``<base>/<entity>``. Reading
    directories (not a glob of files) keeps partition discovery: ``year, month,
    day, hour`` come back as ints and predicates on them prune. ``days`` limits
    the folders that are listed at all. The schema is fixed, so there is no
    inference scan. An entity that the store does not hold is empty; a store that
    does not exist is an error.

    JSON tables of other tools are read as text and go through the same
    parse as ingest: lines that are no record are left out, and a missing
    ``timestamp`` falls back to ``created_utc``.

    ``rescued`` adds ``_rescued``, the text of records that hold more than
    their columns do.
    """
    base = base.rstrip("/")
    schema = stored_schema(entity)
    columns = schema.fieldNames()
    plain = f"{base}/{entity}"
    if fmt == "json":
        parts = T.StructType([T.StructField("value", T.StringType()), *schema.fields[-len(PARTITION_COLUMNS):]])
        lines = spark.read.schema(parts).option("basePath", plain).text(plain)
        parsed = parse(lines.withColumnRenamed("value", "_raw"), entity, keep=PARTITION_COLUMNS)
        found = parsed.filter(F.col("_status") != MALFORMED).select(*columns)
        return found if days is None else on_dates(found, days)
    manifest = load_manifest(spark, base, version)
    if manifest is not None:
        wanted = None if days is None else {str(parse_day(d)) for d in days}
        parts = [p for p in manifest.parts if p.data_type == entity and p.status == OK
                 and (wanted is None or p.day in wanted)]
        schema = T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType(), True)])
        return read_parts(spark, base, parts, schema).select(*columns, *([RESCUED] if rescued else []))
    if path_exists(spark, plain):
        found = spark.read.schema(schema).option("basePath", plain).format(fmt).load(plain)
        return found if days is None else on_dates(found, days)
    if not path_exists(spark, base):
        raise FileNotFoundError(f"no store at {base}")
    return spark.createDataFrame([], schema)


def read_quarantine(spark: SparkSession, base: str, version: int | None = None) -> DataFrame:
    """Rejected records with their reason, of all loads. Only quarantine
    folders are listed; a store without any reads as an empty table."""
    base = base.rstrip("/")
    manifest = load_manifest(spark, base, version)
    parts = [p for p in manifest.parts if p.status != OK] if manifest else []
    names = ["value", *META, "data_type", "status"]
    rows = read_parts(spark, base, parts, T.StructType([f for f in STORED.fields if f.name in names]))
    return rows.select("value", *META, "data_type", F.col("status").alias("reason"))
