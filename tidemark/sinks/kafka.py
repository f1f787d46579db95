"""Kafka as a sink, value only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.kafka import KafkaConfig
from tidemark.streaming.control import StreamControl


def publish_kafka(
    df: DataFrame, config: KafkaConfig, control: StreamControl | None = None, value: str = "value"
) -> StreamingQuery | None:
    """Send one message per row of ``value``.

    Kafka writes are at least once: a task that is run again sends its messages again.
    """
    messages = df.select(df[value].alias("value"))
    if not df.isStreaming:
        messages.write.format("kafka").options(**config.write_options()).save()
        return None
    if control is None:
        raise ValueError("a stream needs a StreamControl")
    writer = messages.writeStream.format("kafka").options(**config.write_options())
    return control.configure(writer).start()
