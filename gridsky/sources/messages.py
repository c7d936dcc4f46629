"""Message streams over Kafka topics or landed text files.

Every reader gives ``value`` (the message text) and ``arrival``, a struct that
orders messages as they came in. The Kafka connector is supplied at submit
time with ``--packages``; here only its options are built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

# Producer settings.
PRODUCER = {
    "kafka.compression.type": "gzip",
    "kafka.acks": "1",
    "kafka.linger.ms": "100",
}


def kafka_source_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    group_prefix: str | None = None,
    max_offsets: int | None = None,
    headers: bool = False,
) -> dict[str, str]:
    """Options of a Kafka read.

    Progress is kept in the query's checkpoint; ``group_prefix`` only names the
    consumer group Spark generates. ``max_offsets`` bounds a micro-batch. ``headers`` are
    read for the id of a message.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if headers:
        options["includeHeaders"] = "true"
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **PRODUCER}


def with_envelope(messages: DataFrame, given: Column | None = None) -> DataFrame:
    """Add ``envelope``, the id of a message: the one that its sender gave, else the digest of its text.

    A producer that is not sure of an acknowledgement sends the same message again; its id stays the same.
    """
    digest = F.sha2(F.col("value").cast("binary"), 256)
    return messages.withColumn("envelope", digest if given is None else F.coalesce(given, digest))


def _header(name: str) -> Column:
    """The newest Kafka header of that name, as text."""
    own = F.filter("headers", lambda h: h["key"] == name)
    return F.try_element_at(own, F.lit(-1))["value"].cast("string")


def read_kafka(
    spark: SparkSession, options: dict[str, str], streaming: bool = True
) -> DataFrame:
    """Messages of a topic. The offset orders them, as producers' clocks may run back.

    Messages with equal table keys must share a partition, which the producer's
    message key sees to; between partitions the order is arbitrary but fixed. With the option
    ``includeHeaders`` the messages have an ``envelope``, by the header of that name.
    """
    reader = spark.readStream if streaming else spark.read
    rows = reader.format("kafka").options(**options).load()
    return kafka_messages(rows, options.get("includeHeaders") == "true")


def kafka_messages(rows: DataFrame, headers: bool = False) -> DataFrame:
    """Messages from the columns that the connector gives."""
    named = rows.withColumns(
        {
            "value": F.col("value").cast("string"),
            "arrival": F.struct("partition", "offset", "timestamp"),
        }
    )
    if not headers:
        return named.select("value", "arrival")
    return with_envelope(named, _header("envelope")).select("value", "arrival", "envelope")


def with_headers(messages: DataFrame) -> DataFrame:
    """Envelopes whose id (``with_envelope``) travels as a Kafka header."""
    header = F.struct(F.lit("envelope").alias("key"), F.col("envelope").cast("binary").alias("value"))
    return messages.withColumn("headers", F.array(header)).drop("envelope")


def _file_position() -> Column:
    # Lines of one block keep their order in the task that reads them.
    return F.struct(
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def read_text_messages(
    spark: SparkSession,
    path: str,
    streaming: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """One message per line, in text files under ``path``."""
    if not streaming:
        source = spark.read.text(path)
    else:
        reader = spark.readStream
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        source = reader.text(path)
    return source.select("value", _file_position().alias("arrival"))


def write_messages(messages: DataFrame, options: dict[str, str]) -> None:
    """Write a batch of envelopes (``value``, optionally ``key``) to Kafka."""
    messages.write.format("kafka").options(**options).save()


def stream_messages(
    messages: DataFrame, options: dict[str, str], checkpoint: str, name: str
) -> StreamingQuery:
    """Write a stream of envelopes to Kafka."""
    return (
        messages.writeStream.queryName(name)
        .format("kafka")
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_text_messages(messages: DataFrame, path: str) -> None:
    """Land a batch of envelopes as text files, one message per line."""
    messages.select("value").write.mode("append").text(path)
