"""Kafka and JDBC connectors (thin: Spark's own formats do the work).

Neither the Kafka connector jar nor a JDBC driver ships with this repo; the
functions only build the reader/writer, so a cluster with those jars on the
classpath can use them. Tests use the file stream source instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblake.sources.envelope import decode, encode


def read_kafka_stream(spark: SparkSession, servers: str, topic: str,
                      starting_offsets: str = "earliest", **options) -> DataFrame:
    """Kafka topic of JSON envelopes -> `(message, log_type)` stream."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets))
    for k, v in options.items():
        reader = reader.option(k, v)
    return decode(reader.load())


def write_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Rows with `message`, `log_type` -> JSON records on a topic."""
    (encode(df).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **props) -> None:
    """Write `df` to a JDBC table; Spark retries failed tasks. An append that failed half-way and is called
    again adds rows twice: stage such a batch in a table of its own (`mode="overwrite"`) and publish it from there."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).mode(mode)
    for k, v in props.items():
        w = w.option(k, v)
    w.save()


def read_jdbc(spark: SparkSession, url: str, table_or_query: str, **props) -> DataFrame:
    """A table (or a parenthesised query) read through JDBC."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table_or_query)
    for k, v in props.items():
        r = r.option(k, v)
    return r.load()
