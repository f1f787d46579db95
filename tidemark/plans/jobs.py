"""The four jobs.

Each landing job takes its values from Kafka, or from any frame with a ``value``
column. Its steps are the same for a batch and for a stream: a batch is written
before the function returns, a stream is started and its query returned.
"""

from __future__ import annotations

import secrets
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.decode import decode_changes
from tidemark.operators.encode import encode_rows
from tidemark.operators.filters import require_keys
from tidemark.operators.generate import change_records, change_stream, line_bytes
from tidemark.operators.project import flatten
from tidemark.plans.config import FlatLandingJob, LandingJob
from tidemark.schema import change_schema
from tidemark.sinks.files import land_json, land_text
from tidemark.sinks.kafka import publish_kafka
from tidemark.sources.kafka import KafkaConfig, kafka_values
from tidemark.streaming.control import StreamControl

# Settings of ``change_records`` that change the sizes of lines.
SIZED_BY = ("timestamp_ms", "prefix", "count", "null_percent", "payload")


def _values(spark: SparkSession, job: LandingJob, values: DataFrame | None) -> DataFrame:
    if values is not None:
        return values
    if job.kafka is None:
        raise ValueError("the job has no kafka settings and no values were given")
    kafka = job.kafka
    if kafka.max_records_per_partition is None and job.policy.record_bytes is not None:
        # A task then reads about what fits in one landed file, and the number of
        # tasks follows the records, not the partitions of the topic.
        kafka = replace(kafka, max_records_per_partition=job.policy.max_records())
    return kafka_values(spark, kafka, invalid=job.invalid)


def land_raw(
    spark: SparkSession, job: LandingJob, values: DataFrame | None = None
) -> StreamingQuery | None:
    """Every value as it came, to rolling text files."""
    return land_text(
        _values(spark, job, values),
        job.output_path,
        job.control("land_raw"),
        job.policy,
        job.compression,
    )


def land_filtered(
    spark: SparkSession, job: LandingJob, values: DataFrame | None = None, keys: tuple[str, ...] = ()
) -> StreamingQuery | None:
    """Values that are JSON objects with the required keys, unchanged, to text files."""
    return land_text(
        require_keys(_values(spark, job, values), *keys),
        job.output_path,
        job.control("land_filtered"),
        job.policy,
        job.compression,
    )


def land_flat_json(
    spark: SparkSession, job: FlatLandingJob, values: DataFrame | None = None
) -> StreamingQuery | None:
    """Change records, decoded and flattened, to JSON files.

    A batch is measured before it is decoded, so that it is decoded once: a line is counted as
    its input and the names of all fields with ``null``, which is seldom less than it becomes.
    """
    schema = change_schema(job.key_prefix, job.key_count)
    rows = _values(spark, job, values)
    flat = flatten(decode_changes(rows, schema))
    policy = job.policy
    if not rows.isStreaming and policy.record_bytes is None and not policy.by_bytes:
        policy = policy.measured(rows.select("value"), sum(len(f'"{name}":null,'.encode()) for name in flat.columns))
    return land_json(flat, job.output_path, job.control("land_flat_json"), policy, job.compression)


def generate_changes(
    spark: SparkSession,
    kafka: KafkaConfig | None = None,
    job: LandingJob | None = None,
    *,
    records: int | None = None,
    rows_per_second: int = 1,
    checkpoint: str | None = None,
    seed: int | None = None,
    mixed_text: bool = True,
    ids: DataFrame | None = None,
    **settings,
) -> StreamingQuery | None:
    """Synthetic change records, to a topic or to text files of JSON lines.

    ``records`` makes that many and ends, ``ids`` one for each of its rows (by the column
    ``row_id`` of ``settings``); without either the stream runs on at
    ``rows_per_second``. A batch to files is told the mean size of its lines, so it draws them once. Texts are of letters and digits, or of hex digits without
    ``mixed_text``. Without a ``seed`` one is drawn, so that every run makes new records; a
    stream that starts again on its checkpoint should be given the seed it had.
    """
    if (kafka is None) == (job is None):
        raise ValueError("give either kafka or job")
    if ids is not None and records is not None:
        raise ValueError("give either records or ids")
    settings |= {"seed": secrets.randbits(62) if seed is None else seed, "mixed_text": mixed_text}
    if ids is None and records is None:
        rows = change_stream(spark, rows_per_second, **settings)
    else:
        source = spark.range(records) if ids is None else ids
        rows = change_records(source, **settings)
    lines = encode_rows(rows)
    if job is not None:
        control = job.control("generate_changes") if lines.isStreaming else None
        policy = job.policy
        if not lines.isStreaming and policy.record_bytes is None and not policy.by_bytes and "keep" not in settings:
            policy = replace(policy, record_bytes=line_bytes(source, **{k: v for k, v in settings.items() if k in SIZED_BY}))
        return land_text(lines, job.output_path, control, policy, job.compression)
    control = None
    if lines.isStreaming:
        if not checkpoint:
            raise ValueError("an unbounded run to a topic needs a checkpoint")
        control = StreamControl(checkpoint, "generate_changes")
    return publish_kafka(lines, kafka, control)
