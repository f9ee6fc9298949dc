"""Transaction messages: JSON encode and decode, stream sources and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.scalars import format_event_time
from tallywatch.schema import MESSAGE_FIELDS, MESSAGE_SCHEMA


def decode(raw: DataFrame, value: str = "value") -> DataFrame:
    """Message bytes or text to the ten wire columns.

    A record that is no JSON object becomes all NULL; one bad field makes only that field NULL.
    """
    message = F.from_json(F.col(value).cast("string"), MESSAGE_SCHEMA)
    return raw.select(message.alias("m")).select("m.*")


def encode(tx: DataFrame) -> DataFrame:
    """Ledger-shaped rows to one ``value`` column of JSON messages (NULL fields are left out)."""
    fields: list[Column] = [
        format_event_time("ts").alias("date") if name == "date" else F.col(name) for name in MESSAGE_FIELDS
    ]
    return tx.select(F.to_json(F.struct(*fields)).alias("value"))


def kafka_source_options(
    bootstrap: str,
    topic: str,
    *,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_kafka_stream(spark: SparkSession, bootstrap: str, topic: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka").options(**kafka_source_options(bootstrap, topic, **options))
    return reader.load().select("value")


def read_line_stream(
    spark: SparkSession, path: str, max_per_trigger: int | None = None, max_bytes: str | int | None = None, fail_on_data_loss: bool = True
) -> DataFrame:
    """Text files of JSON lines as a stream; ``max_per_trigger`` counts files per micro-batch, ``max_bytes`` their bytes (one file at least).

    A file that was promised to a batch and is gone when it is read fails the stream, or is passed over without ``fail_on_data_loss``.
    """
    limits = {"maxFilesPerTrigger": max_per_trigger, "maxBytesPerTrigger": max_bytes}
    reader = spark.readStream.format("text").option("ignoreMissingFiles", not fail_on_data_loss)
    return reader.options(**{k: v for k, v in limits.items() if v is not None}).load(path)


def read_transaction_stream(spark: SparkSession, fmt: str, location: str, *, topic: str = "transactions", **options) -> DataFrame:
    """Decoded transaction stream from ``kafka`` (location = bootstrap servers) or ``json-lines`` (location = folder)."""
    if fmt == "kafka":
        return decode(read_kafka_stream(spark, location, topic, **options))
    if fmt == "json-lines":
        return decode(read_line_stream(spark, location, **options))
    raise ValueError(f"unknown stream format {fmt!r}; use 'kafka' or 'json-lines'")


def write_messages(messages: DataFrame, fmt: str, location: str, *, topic: str = "transactions") -> None:
    """Write a ``value`` column of messages to a Kafka topic or as text files."""
    if fmt == "kafka":
        writer = messages.write.format("kafka").option("kafka.bootstrap.servers", location).option("topic", topic)
        writer.save()
    elif fmt == "json-lines":
        messages.write.mode("append").text(location)
    else:
        raise ValueError(f"unknown message format {fmt!r}; use 'kafka' or 'json-lines'")
