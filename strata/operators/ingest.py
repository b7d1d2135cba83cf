"""Ingest: wire records → validated rows + quarantine, and the hour-partitioned store.

One parse produces every row with a ``_status``: ``ok``, or the reason it is
quarantined (``malformed_json``, ``missing_time``, ``bad_time``,
``unknown_topic`` and the opt-in ``future_time``). Nothing is dropped
silently: rows in = stored rows + quarantined rows. A record with fields
that the schema lacks, or whose value is of another type, is stored with its
whole text in ``_rescued``.

One load is one write: stored and quarantined rows of all entities go out
together and are shown at once by the store's manifest (``strata.store``); a
load that runs again replaces all that it wrote before. Batch, bootstrap and
stream use the same writer.
"""

from __future__ import annotations

import functools
import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.records import data_type_of, evaluate_once
from ..functions.time import raw_time, row_time
from ..schemas import ENTITY_SCHEMAS, META_FIELDS, PARTITION_COLUMNS, RECORD
from ..store import commit_load

# Ingest status of a record: stored when OK, quarantined under the others.
OK, MALFORMED, MISSING_TIME, BAD_TIME, FUTURE_TIME, UNKNOWN_TOPIC = (
    "ok", "malformed_json", "missing_time", "bad_time", "future_time", "unknown_topic")
REASONS = (MALFORMED, MISSING_TIME, BAD_TIME, FUTURE_TIME, UNKNOWN_TOPIC)

META = [f.name for f in META_FIELDS]
RESCUED = "_rescued"

# The fields the status depends on, shared by every entity.
TIME_FIELDS = T.StructType([T.StructField("created_utc", T.StringType(), True),
                            T.StructField("timestamp", T.StringType(), True)])


def route(envelope: DataFrame) -> DataFrame:
    """Envelope → (data_type, text, metadata): one reader over several
    topics, each record routed by its topic's last dotted part."""
    return envelope.select(
        data_type_of(F.col("topic")).alias("data_type"),
        F.col("value").cast("string").alias("_raw"),
        F.col("key").cast("string").alias("_key"), F.col("topic").alias("_topic"),
        F.col("partition").alias("_partition"), F.col("offset").alias("_offset"),
        F.col("timestamp").alias("_arrival"))


def _decoded(element: T.DataType, end: str) -> Column:
    """The text in ``_raw`` decoded as the first element of an array whose second
    and last is ``{"<end>": "1"}``. Text behind the record, text that closes the
    array, or a second record gives other elements. ``end`` is a name that no
    record can know. Numbers are decoded as text: ``parse`` casts them and can
    tell a value that does not fit from none."""
    return F.from_json(F.concat(F.lit("["), F.col("_raw"), F.lit(f',{{"{end}":"1"}}]')), T.ArrayType(element))


def parse(texts: DataFrame, entity: str | None, keep: list[str] | None = None,
          max_future: str | None = None, fields: list[str] | None = None, rescue: bool = False) -> DataFrame:
    """Decode the ``_raw`` JSON text of one entity and classify each row.

    Output: the entity fields (``timestamp`` parsed to a timestamp,
    ``created_utc`` kept as text), ``_status`` and ``_raw``, plus ``keep``.
    A number that does not fit its field (``1.5`` for a long) is NULL while
    the row is kept; a number sent as text is read. Text that is not exactly
    one JSON object is malformed.

    The text is parsed once: ``evaluate_once`` keeps what is derived from the
    parsed record, and later filters on that, from being rewritten into fresh
    parses of the text. The record is judged once, too: callers use status and
    times in each of their columns, which would check the record and read its
    time again for each.

    ``max_future`` (e.g. ``"1 hour"``, off by default): a record whose event
    time is more than that after its arrival (``_arrival``) is quarantined
    as ``future_time``; replayed into a stream it would push the watermark
    ahead and make live records look late.

    ``entity=None`` decodes only the two time fields: enough for the status,
    which is the same under every entity's schema; ``entity="*"`` decodes the
    fields of all entities. ``fields`` limits decoding to those named (and
    the times). With ``rescue`` a row whose text holds more than its columns
    do (other fields, a key sent twice) has that text in ``_rescued``.
    """
    base = RECORD if entity == "*" else ENTITY_SCHEMAS[entity] if entity else TIME_FIELDS
    if fields is not None:
        base = T.StructType([f for f in base.fields if f.name in fields or f.name in TIME_FIELDS.fieldNames()])
    keep = [c for c in (keep or []) if c in texts.columns]
    end = f"_end_{uuid.uuid4().hex}"
    names = [f.name for f in base.fields]
    # To rescue what the columns cannot hold, all keys are needed: the record is then a map.
    element = (T.MapType(T.StringType(), T.StringType()) if rescue else
               T.StructType([T.StructField(n, T.StringType()) for n in [*names, end]]))
    d = evaluate_once(texts.select(*keep, "_raw", _decoded(element, end).alias("_found")))

    def value(record: Column, name: str) -> Column:
        return F.try_element_at(record, F.lit(name)) if rescue else record.getField(name)
    first, last = F.get("_found", F.lit(0)), F.get("_found", F.lit(1))
    whole = (F.size("_found") == 2) & value(last, end).isNotNull() & value(first, end).isNull() & F.col("_raw").rlike(r"^\s*\{")
    d = evaluate_once(d.select(*keep, "_raw", F.when(whole, first).alias("_rec")))
    columns, lost = [], F.lit(False)
    for f in base.fields:
        text = value(F.col("_rec"), f.name)
        if isinstance(f.dataType, T.LongType):
            columns.append(text.try_cast("bigint").alias(f.name))
            lost = lost | (text.isNotNull() & text.try_cast("bigint").isNull())
        else:
            columns.append(text.alias(f.name))
    if rescue:
        keys = F.map_keys("_rec")
        extra = F.size(F.array_except(keys, F.lit(names))) > 0
        twice = F.size(F.array_distinct(keys)) < F.size(keys)
        columns.append(F.when(F.col("_rec").isNotNull() & (lost | extra | twice), F.col("_raw")).alias(RESCUED))
    d = d.select(*keep, "_raw", F.col("_rec").isNull().alias("_malformed"), *columns)
    status = (F.when(F.col("_malformed"), F.lit(MALFORMED))
              .when(raw_time().isNull(), F.lit(MISSING_TIME))
              .when(row_time().isNull(), F.lit(BAD_TIME)))
    if max_future is not None and "_arrival" in d.columns:
        if not re.fullmatch(r"\d+ (second|minute|hour|day)s?", max_future):
            raise ValueError(f"max_future must look like '2 hours', got {max_future!r}")
        status = status.when(row_time() > F.col("_arrival") + F.expr(f"INTERVAL {max_future}"),
                             F.lit(FUTURE_TIME))
    status = status.otherwise(F.lit(OK))
    return evaluate_once(d.withColumns({"_status": status, "timestamp": row_time()}).drop("_malformed"))


def decode_entity(envelope: DataFrame, entity: str, strict_time: bool = False,
                  max_future: str | None = None, fields: list[str] | None = None) -> DataFrame:
    """Envelope (batch or stream) → decoded rows of one entity.

    Malformed JSON never becomes an all-NULL row; with ``strict_time`` rows
    without a usable time are left out as well (windows ignore them anyway).
    ``fields`` names what the caller uses: other fields are not decoded.
    """
    routed = route(envelope).filter(F.col("data_type") == entity)
    parsed = parse(routed, entity, keep=META, max_future=max_future, fields=fields)
    ok = (F.col("_status") == OK) if strict_time else F.col("_status").isin(OK, MISSING_TIME, BAD_TIME)
    return parsed.filter(ok).drop("_status", "_raw")


def classify(envelope: DataFrame, max_future: str | None = None) -> DataFrame:
    """Every envelope row with its data_type and ingest status. The status
    depends only on JSON syntax and the two time fields, which all entities
    share, so one narrow parse classifies every topic."""
    return parse(route(envelope), None, keep=["data_type"] + META, max_future=max_future).select(
        "data_type", *META, "_status", "_raw", "timestamp")


def with_partition_columns(df: DataFrame) -> DataFrame:
    """year / month / day / hour of the UTC event time, spelled two-digit on
    disk (``month=01``); partition discovery reads them back as ints."""
    t = F.col("timestamp")
    return df.withColumns({
        "year": F.year(t).cast("string"),
        "month": F.lpad(F.month(t).cast("string"), 2, "0"),
        "day": F.lpad(F.dayofmonth(t).cast("string"), 2, "0"),
        "hour": F.lpad(F.hour(t).cast("string"), 2, "0"),
    })


def stored_rows(parsed: DataFrame, entity: str) -> DataFrame:
    fields = [f.name for f in ENTITY_SCHEMAS[entity].fields]
    return with_partition_columns(parsed.filter(F.col("_status") == OK).select(*fields))


def write_partitioned(rows: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                      max_records_per_file: int = 1_000_000) -> None:
    """Append rows under ``path/year=/month=/day=/hour=``.

    The ``rebalance`` hint asks AQE for evenly sized write tasks by the
    partition columns: small hours are coalesced, and an hour holding a
    large share of the data is split over several tasks instead of one.
    Task-unique file names mean concurrent writers never collide.
    """
    (rows.hint("rebalance", *PARTITION_COLUMNS)
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*PARTITION_COLUMNS).format(fmt).save(path))


def load_rows(texts: DataFrame, load: str, entities=("posts", "comments", "users"),
              max_future: str | None = None) -> DataFrame:
    """Routed texts → one row per record, as a load is written: the fields of
    all entities, and for quarantined rows the text and its metadata.

    Records of a known entity that is not among ``entities`` are left out by
    request; those of no known entity are quarantined.
    """
    known = F.col("data_type").isin(list(ENTITY_SCHEMAS))
    wanted = texts.filter(~F.coalesce(known, F.lit(False)) | F.col("data_type").isin(list(entities)))
    parsed = parse(wanted, "*", keep=["data_type"] + META, max_future=max_future, rescue=True)
    status = F.when(F.coalesce(known, F.lit(False)), F.col("_status")).otherwise(F.lit(UNKNOWN_TOPIC))
    parsed = parsed.withColumn("status", status)
    ok = F.col("status") == OK
    # Fields of other entities are extra fields of this one.
    own = functools.reduce(lambda c, e: c.when(F.col("data_type") == e, F.lit(ENTITY_SCHEMAS[e].fieldNames())),
                           ENTITY_SCHEMAS, F.when(F.lit(False), F.lit(list(RECORD.fieldNames()))))
    others = functools.reduce(Column.__or__, (
        F.col(f.name).isNotNull() & ~F.array_contains(own, f.name) for f in RECORD.fields
        if not all(f.name in e.fieldNames() for e in ENTITY_SCHEMAS.values())))
    rows = with_partition_columns(parsed)
    return rows.select(
        *(F.when(ok, F.col(f.name)).alias(f.name) for f in RECORD.fields),
        F.when(ok, F.coalesce(F.col(RESCUED), F.when(others, F.col("_raw")))).alias(RESCUED),
        F.when(~ok, F.col("_raw")).alias("value"),
        *(F.when(~ok, F.col(c)).alias(c) for c in META if c in rows.columns),
        F.coalesce("data_type", F.lit("")).alias("data_type"), "status", F.lit(load).alias("load"),
        *(F.when(ok, F.col(c)).alias(c) for c in PARTITION_COLUMNS))


def write_load(rows: DataFrame, base: str, load: str, max_records_per_file: int = 1_000_000) -> int:
    """Write one load's rows in one job and show them at once, in the place of
    all that the same load wrote before. The store's version that shows them."""
    return commit_load(rows.sparkSession, base, load, rows, max_records_per_file)


def ingest_batch(envelope: DataFrame, base: str, entities=("posts", "comments", "users"),
                 max_future: str | None = None, load: str = "batch") -> None:
    """Batch ingest of the given entities' records into the store, as load
    ``load``. The same load again replaces its rows; another name adds.
    A topic-partitioned landing folder is pruned to the topics read."""
    write_load(load_rows(route(envelope), load, entities, max_future), base, load)
