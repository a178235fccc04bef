"""Readers that deliver a topic as a DataFrame of envelope rows.

The envelope is the column set of Spark's Kafka source with key and value cast
to text. The same columns come from Kafka, from an archived topic in files and
from any table, in batch and as a stream, so every plan runs on all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.schemas import ENVELOPE


def kafka_topic(
    spark: SparkSession, servers: str, topic: str, *, streaming: bool = True,
    min_partitions: int | None = None, max_offsets_per_trigger: int | None = None, with_source: bool = False,
    **options: str,
) -> DataFrame:
    """A Kafka topic from its earliest record on (needs the Kafka connector on the class path).

    ``min_partitions`` splits large topic partitions over more tasks;
    ``max_offsets_per_trigger`` bounds one micro-batch during a long replay;
    ``with_source`` reads messages this engine has written and restores the
    place of their source records (see ``with_source_place``).
    """
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", "earliest")
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    if streaming and max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if with_source:
        return with_source_place(reader.option("includeHeaders", "true").options(**options).load())
    return as_envelope(reader.options(**options).load())


SOURCE_HEADER = "source"


def with_source_place(records: DataFrame) -> DataFrame:
    """Kafka rows with ``headers`` as envelope rows plus ``sourceTopic``, ``sourcePartition``, ``sourceOffset``.

    The last header named ``source`` counts, as in Kafka's own lookup; without
    one, or with one that is no place, the three columns are null.
    """
    named = F.filter("headers", lambda h: h["key"] == SOURCE_HEADER)
    place = F.try_element_at(named, F.lit(-1))["value"].cast("string")
    part = lambda i: F.regexp_extract(place, r"(?s)^(.*)/([0-9]+)/([0-9]+)$", i)
    return records.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE],
        F.nullif(part(1), F.lit("")).alias("sourceTopic"),
        part(2).try_cast("int").alias("sourcePartition"),
        part(3).try_cast("long").alias("sourceOffset"),
    )


def file_topic(
    spark: SparkSession, path: str, *, streaming: bool = False, fmt: str = "parquet",
    max_files_per_trigger: int | None = None, **options: str,
) -> DataFrame:
    """An archived topic: files that already hold the envelope columns."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).schema(ENVELOPE)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return as_envelope(reader.options(**options).load(path))


def table_files(
    spark: SparkSession, folder: str, name: str, schema: str | T.StructType, *, streaming: bool = False,
) -> DataFrame:
    """``folder/name.parquet`` as a batch or as a stream of the same rows."""
    if not streaming:
        return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
    # A file stream watches a folder, so the name goes into the file filter.
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(folder)
    )


def as_envelope(df: DataFrame) -> DataFrame:
    """Cast the six envelope columns to their types; other columns go."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE])


def envelope(
    df: DataFrame, value: Column, *, key: Column, topic: str, offset: Column,
    timestamp: Column, partition: Column | None = None,
) -> DataFrame:
    """Envelope rows from any table; ``offset`` must be unique within ``partition``."""
    return df.select(
        key.cast("string").alias("key"),
        value.cast("string").alias("value"),
        F.lit(topic).alias("topic"),
        (F.lit(0) if partition is None else partition).cast("int").alias("partition"),
        offset.cast("long").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )
