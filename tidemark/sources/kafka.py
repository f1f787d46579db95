"""Kafka as a source of values, and the connection options it shares with the sink.

The connector is not part of PySpark; submit with
``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EARLIEST = "earliest"
LATEST = "latest"

# Records of one batch, unless the caller says otherwise. None takes all there are.
OFFSETS_PER_BATCH = 50_000_000


@dataclass(frozen=True)
class KafkaSecurity:
    """SASL over TLS with Kerberos; stores and passwords come from the caller's config.

    Ticket handling itself (keytab, principal, login module) belongs to the
    cluster: ``spark-submit --keytab --principal``.
    """

    protocol: str = "SASL_SSL"
    mechanism: str = "GSSAPI"
    kerberos_service_name: str = "kafka"
    truststore_location: str | None = None
    truststore_password: str | None = field(default=None, repr=False)
    keystore_location: str | None = None
    keystore_password: str | None = field(default=None, repr=False)
    key_password: str | None = field(default=None, repr=False)

    def options(self) -> dict[str, str]:
        settings = {
            "kafka.security.protocol": self.protocol,
            "kafka.sasl.mechanism": self.mechanism,
            "kafka.sasl.kerberos.service.name": self.kerberos_service_name,
            "kafka.ssl.truststore.location": self.truststore_location,
            "kafka.ssl.truststore.password": self.truststore_password,
            "kafka.ssl.keystore.location": self.keystore_location,
            "kafka.ssl.keystore.password": self.keystore_password,
            "kafka.ssl.key.password": self.key_password,
        }
        return {name: value for name, value in settings.items() if value is not None}


@dataclass(frozen=True)
class KafkaConfig:
    """One topic on one set of brokers.

    ``starting_offsets`` counts only for a query without a checkpoint; afterwards
    the position is the checkpoint's; Spark keeps no position in a group. Each query
    has a group of its own, whose name begins with ``group_id_prefix``. A fixed
    ``group_id`` is for brokers that grant one name only: no two queries may then run
    at once, for each would be given a part of the records.

    A topic partition is one task unless it is split. ``max_records_per_partition``
    splits by size, so that a partition holding most of the records becomes many
    tasks; ``min_partitions`` asks for a number of tasks whatever the size.
    ``max_offsets_per_trigger`` bounds a batch, which matters for the first batch
    of an old topic read from the earliest offset: what is left waits for the next.
    """

    bootstrap_servers: str
    topic: str
    group_id: str | None = None
    starting_offsets: str = EARLIEST
    security: KafkaSecurity | None = None
    max_records_per_partition: int | None = None
    min_partitions: int | None = None
    max_offsets_per_trigger: int | None = OFFSETS_PER_BATCH
    group_id_prefix: str | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for name in ("bootstrap_servers", "topic"):
            if not getattr(self, name):
                raise ValueError(f"{name} is required")
        if "," in self.topic:
            raise ValueError("one topic per source")

    def _connection(self) -> dict[str, str]:
        secured = self.security.options() if self.security else {}
        return {"kafka.bootstrap.servers": self.bootstrap_servers, **secured}

    def read_options(self) -> dict[str, str]:
        options = {
            **self._connection(),
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
        }
        if self.group_id_prefix and not self.group_id:
            options["groupIdPrefix"] = self.group_id_prefix
        if self.group_id:
            options["kafka.group.id"] = self.group_id
        if self.max_records_per_partition:
            options["maxRecordsPerPartition"] = str(self.max_records_per_partition)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        if self.max_offsets_per_trigger:
            options["maxOffsetsPerTrigger"] = str(self.max_offsets_per_trigger)
        return {**options, **self.extra}

    def write_options(self) -> dict[str, str]:
        """Connection and topic only: ``extra`` holds reader options."""
        return {**self._connection(), "topic": self.topic}


def utf8_text(value: Column | str, invalid: str = "replace") -> Column:
    """Bytes as text. Bytes that are not UTF-8 are replaced by U+FFFD, kept, or make NULL."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    if invalid == "replace":
        return F.make_valid_utf8(text)
    if invalid == "null":
        return F.try_validate_utf8(text)
    if invalid == "keep":
        return text
    raise ValueError(f"invalid must be replace, null or keep, got {invalid!r}")


def kafka_values(
    spark: SparkSession, config: KafkaConfig, *, streaming: bool = True, invalid: str = "replace"
) -> DataFrame:
    """The values of a topic as text; key, headers, offset and broker time are dropped.

    No watermark is set and the query is stateless.
    """
    reader = spark.readStream if streaming else spark.read
    records = reader.format("kafka").options(**config.read_options()).load()
    return records.select(utf8_text("value", invalid).alias("value"))
