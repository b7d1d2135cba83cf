"""Record streams in Kafka's envelope.

``kafka_source`` is Spark's own Kafka reader (the connector jar must be on
the classpath; it is not installed in this image). ``file_envelope_source``
is the test double: a Parquet folder with the same columns, read as a
stream, so everything downstream is the same code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ENVELOPE, TOPICS


def kafka_source(spark: SparkSession, servers: str, topics=None,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 min_partitions: int | None = None, extra: dict[str, str] | None = None) -> DataFrame:
    """Spark's Kafka reader over ``topics`` (default: all three).

    ``max_offsets_per_trigger`` bounds a micro-batch; ``min_partitions``
    lets Spark split the offset range of a busy topic partition over
    several tasks, so one hot partition does not become one task.
    """
    topics = topics or list(TOPICS.values())
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", ",".join(topics) if not isinstance(topics, str) else topics)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    for k, v in (extra or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def file_envelope_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


#: Folders that a task of ``write_envelope`` writes side by side; only for more it sorts.
OPEN_FOLDERS = 16


def write_envelope(envelope: DataFrame, path: str, mode: str = "append", by=("topic",)) -> None:
    """Land an envelope DataFrame where ``file_envelope_source`` reads it:
    one folder per topic (``topic=...``), so a reader of one entity prunes
    the others' files. ``by``: the columns of the folders.

    Each task writes its records as they come, to one file for each folder. No
    task gathers or sorts a topic: a storm of equal records is small in a
    shuffle, so one task would get all of it, however many there are."""
    conf, most = envelope.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(most)
    conf.set(most, str(max(OPEN_FOLDERS, int(before))))
    try:
        envelope.write.mode(mode).partitionBy(*by).parquet(path)
    finally:
        conf.set(most, before)
