"""Throughput of the operators and the headline queries; prints one JSON line.

``value`` is the time of the operators. ``queries`` are the registered queries as they are, end to end: reading a table,
making one message per row from it, and the operator. ``operators`` times the
operators alone on messages landed beforehand: the best of ``BENCH_RUNS`` runs
(default 1) after a first one. Queries run once: a table that is one parquet row group
is one task, so their time is mostly that of making messages on one core. Results go to Spark's noop sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import time

from pyspark import __version__ as spark_version
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.decode import decode_changes
from tidemark.operators.encode import encode_rows
from tidemark.operators.filters import require_keys
from tidemark.operators.project import flatten, project_envelope
from tidemark.plans.config import FlatLandingJob, LandingJob
from tidemark.plans.jobs import land_filtered, land_flat_json, land_raw
from tidemark.queries import inputs
from tidemark.queries.catalog import CATALOG
from tidemark.schema import ENVELOPE_FIELDS, change_schema, narrow
from tidemark.sources.files import text_values
from tidemark.streaming.control import finish
from tidemark.streaming.workspace import workspace

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

HEADLINE = [
    "raw_passthrough",
    "json_table_source",
    "json_skip_malformed",
    "json_bad_field_null",
    "json_encode",
    "json_document_round_trip",
    "project_envelope",
    "flatten_record",
    "json_has_keys",
    "filtered_landing",
    "json_landing",
    "insert_select",
    "restart_no_duplicates",
    "gen_change_records",
    "gen_null_share",
]


def compute(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    """The best of the runs after a first one."""
    seconds = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(min(seconds[1:] or seconds), 3)


def operator_actions(spark: SparkSession, root: str):
    """Name, input path and action of each operator over landed messages."""
    changes, bad, events = f"{root}/changes", f"{root}/damaged", f"{root}/events"
    table = inputs.table(spark, SF_DIR, "events")
    inputs.change_messages(table).select("value").write.text(changes)
    inputs.damaged_messages(table).select("value").write.text(bad)
    inputs.event_messages(table).select("value").write.text(events)
    schema = change_schema()
    envelope = narrow(schema, *ENVELOPE_FIELDS)
    typed = f"{root}/typed"
    decode_changes(text_values(spark, changes), schema).write.parquet(typed)

    def job(kind, name):
        made = workspace(spark, f"bench-{name}")
        return kind(f"{made}/landed", checkpoint=f"{made}/checkpoint", available_now=True)

    def stream(path):
        return text_values(spark, path, streaming=True)

    return [
        ("decode_flatten", changes, lambda: compute(
            flatten(decode_changes(text_values(spark, changes), schema)))),
        ("decode_flatten_damaged", bad, lambda: compute(
            flatten(decode_changes(text_values(spark, bad), schema)))),
        ("decode_envelope", changes, lambda: compute(
            project_envelope(decode_changes(text_values(spark, changes), envelope)))),
        ("require_keys", events, lambda: compute(require_keys(text_values(spark, events)))),
        ("encode", typed, lambda: compute(encode_rows(spark.read.parquet(typed)))),
        ("land_raw_stream", changes, lambda: finish(
            land_raw(spark, job(LandingJob, "raw"), stream(changes)))),
        ("land_filtered_stream", events, lambda: finish(
            land_filtered(spark, job(LandingJob, "filtered"), stream(events)))),
        ("land_flat_json_stream", changes, lambda: finish(
            land_flat_json(spark, job(FlatLandingJob, "flat"), stream(changes)))),
        ("land_flat_json_batch", changes, lambda: land_flat_json(
            spark, FlatLandingJob(f"{workspace(spark, 'bench-batch')}/landed"),
            text_values(spark, changes))),
    ]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.maxPartitionBytes", "16m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    once = {}
    for name in HEADLINE:
        start = time.perf_counter()
        compute(CATALOG[name].run(spark, SF_DIR))
        once[name] = round(time.perf_counter() - start, 3)

    operators = {}
    for name, path, action in operator_actions(spark, workspace(spark, "bench")):
        seconds = timed(action)
        size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
        rows = (
            spark.read.parquet(path) if path.endswith("/typed") else text_values(spark, path)
        ).count()
        operators[name] = {
            "sec": seconds,
            "records_per_sec": round(rows / seconds),
            "input_mb_per_sec": round(size / seconds / 1e6, 1),
        }

    print(
        json.dumps(
            {
                "metric": "total of operators on landed messages, best warm run each",
                "value": round(sum(x["sec"] for x in operators.values()), 3),
                "unit": "sec",
                "queries_total": round(sum(once.values()), 3),
                "queries": once,
                "operators": operators,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cores": int(CPUS),
                "spark": spark_version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
