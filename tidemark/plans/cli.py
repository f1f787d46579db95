"""Command line of the jobs, for ``spark-submit landing_job.py <job> …``.

Parameter names are accepted with dashes and with dots.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.plans.config import GROUP_IDS, FlatLandingJob, LandingJob
from tidemark.plans.jobs import generate_changes, land_filtered, land_flat_json, land_raw
from tidemark.operators.filters import EVENT_KEYS
from tidemark.schema import KEY_COUNT, KEY_PREFIX
from tidemark.sinks.rolling import MIB, RollingPolicy
from tidemark.sources.kafka import EARLIEST, LATEST, OFFSETS_PER_BATCH, KafkaConfig, KafkaSecurity
from tidemark.streaming.control import finish

JOBS = {"raw": land_raw, "filtered": land_filtered, "flat": land_flat_json}
STARTING_OFFSETS = {"raw": EARLIEST, "filtered": LATEST, "flat": EARLIEST}
SECURED = {"raw": True, "filtered": True, "flat": False, "generate": False}

# TLS stores and their passwords come from the session's configuration (for
# example a --properties-file), under these names.
SECURITY_SETTINGS = {
    "truststore_location": "spark.tidemark.ssl.truststore.location",
    "truststore_password": "spark.tidemark.ssl.truststore.password",
    "keystore_location": "spark.tidemark.ssl.keystore.location",
    "keystore_password": "spark.tidemark.ssl.keystore.password",
    "key_password": "spark.tidemark.ssl.key.password",
}


def _connection_arguments(parser: argparse.ArgumentParser, required: bool) -> None:
    parser.add_argument(
        "--kafka-bootstrap-servers", "--kafka.bootstrap.servers", required=required
    )
    parser.add_argument("--kerberos-service-name", "--kerberos.service.name", default="kafka")
    parser.add_argument("--security", choices=("sasl_ssl", "none"))


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="landing_job.py", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)
    for job, run in JOBS.items():
        landing = jobs.add_parser(job, help=run.__doc__)
        _connection_arguments(landing, required=True)
        landing.add_argument("--kafka-topic", "--kafka.topic", required=True)
        landing.add_argument(
            "--output-path", "--hdfs.output.path", dest="output_path", required=True
        )
        landing.add_argument("--kafka-group-id", "--kafka.group.id", help="one fixed group")
        landing.add_argument(
            "--starting-offsets", choices=(EARLIEST, LATEST), default=STARTING_OFFSETS[job]
        )
        landing.add_argument("--checkpoint")
        landing.add_argument("--interval", help="time between batches, by default 15 minutes")
        landing.add_argument("--available-now", action="store_true")
        landing.add_argument("--compression", default="none")
        landing.add_argument("--min-partitions", type=int)
        landing.add_argument("--max-offsets-per-trigger", type=int, default=OFFSETS_PER_BATCH)
        landing.add_argument("--max-records-per-partition", type=int)
        landing.add_argument("--invalid-bytes", choices=("replace", "null", "keep"), default="replace")
        landing.add_argument("--max-part-bytes", type=int, default=128 * MIB)
        landing.add_argument("--record-bytes", type=float, help="mean size of a record, measured")
        landing.add_argument("--rebalance", action="store_true")
        if job == "filtered":
            landing.add_argument("--keys", nargs="+", default=EVENT_KEYS)
        if job == "flat":
            landing.add_argument("--key-prefix", default=KEY_PREFIX)
            landing.add_argument("--key-count", type=int, default=KEY_COUNT)
    generate = jobs.add_parser("generate", help=generate_changes.__doc__)
    target = generate.add_mutually_exclusive_group(required=True)
    target.add_argument("--kafka-topic", "--kafka.topic")
    target.add_argument("--output-path", "--hdfs.output.path", dest="output_path")
    _connection_arguments(generate, required=False)
    generate.add_argument("--records", type=int)
    generate.add_argument("--rows-per-second", type=int, default=1)
    generate.add_argument("--checkpoint")
    generate.add_argument("--seed", type=int, help="by default a new one")
    generate.add_argument("--hex-text", action="store_true")
    return parser


def kafka_config(arguments: argparse.Namespace, settings: dict[str, str]) -> KafkaConfig:
    """Kafka settings from the command line, secrets from the session's settings."""
    secured = SECURED[arguments.job]
    if arguments.security:
        secured = arguments.security == "sasl_ssl"
    security = None
    if secured:
        stores = {field: settings.get(name) for field, name in SECURITY_SETTINGS.items()}
        security = KafkaSecurity(
            kerberos_service_name=arguments.kerberos_service_name, **stores
        )
    return KafkaConfig(
        arguments.kafka_bootstrap_servers,
        arguments.kafka_topic,
        group_id=getattr(arguments, "kafka_group_id", None),
        starting_offsets=getattr(arguments, "starting_offsets", EARLIEST),
        security=security,
        min_partitions=getattr(arguments, "min_partitions", None),
        max_records_per_partition=getattr(arguments, "max_records_per_partition", None),
        max_offsets_per_trigger=getattr(arguments, "max_offsets_per_trigger", None),
        group_id_prefix=GROUP_IDS.get(arguments.job),
    )


def landing_job(arguments: argparse.Namespace, settings: dict[str, str]) -> LandingJob:
    make, own = LandingJob, {}
    if arguments.job == "flat":
        make = FlatLandingJob
        own = {"key_prefix": arguments.key_prefix, "key_count": arguments.key_count}
    return make(
        output_path=arguments.output_path,
        kafka=kafka_config(arguments, settings),
        checkpoint=arguments.checkpoint,
        interval=arguments.interval,
        available_now=arguments.available_now,
        compression=arguments.compression,
        invalid=arguments.invalid_bytes,
        policy=RollingPolicy(
            max_part_bytes=arguments.max_part_bytes,
            record_bytes=arguments.record_bytes,
            rebalance=arguments.rebalance,
        ),
        **own,
    )


def _session_settings(spark: SparkSession) -> dict[str, str]:
    found = {name: spark.conf.get(name, None) for name in SECURITY_SETTINGS.values()}
    return {name: value for name, value in found.items() if value is not None}


def main(argv: Sequence[str] | None = None) -> None:
    arguments = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"change landing: {arguments.job}").getOrCreate()
    if arguments.job == "generate":
        to_topic = arguments.kafka_topic is not None
        query = generate_changes(
            spark,
            kafka_config(arguments, _session_settings(spark)) if to_topic else None,
            None
            if to_topic
            else LandingJob(arguments.output_path, checkpoint=arguments.checkpoint),
            records=arguments.records,
            rows_per_second=arguments.rows_per_second,
            checkpoint=arguments.checkpoint,
            seed=arguments.seed,
            mixed_text=not arguments.hex_text,
        )
    else:
        own = {"keys": tuple(arguments.keys)} if arguments.job == "filtered" else {}
        query = JOBS[arguments.job](spark, landing_job(arguments, _session_settings(spark)), **own)
    if query is not None:
        finish(query)
