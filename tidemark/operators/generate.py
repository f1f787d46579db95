"""Synthetic change records at any scale.

Each record is a function of one row id, so any frame with an id column can be
the driver: a table, ``spark.range``, or an unbounded ``rate`` stream. The work
is a projection; only the ids of a batch of few parts are shuffled, to spread it over all cores.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json_text import to_json_line
from tidemark.functions.sql import sql_name, sql_text
from tidemark.functions.synthetic import TEXT_LENGTH, Draw, digests
from tidemark.schema import (
    KEY_COUNT,
    KEY_PREFIX,
    NAMED_PAYLOAD_FIELDS,
    PAYLOAD,
    key_names,
)

# The value pools and the share of NULLs of the sample feed.
RECORD_TYPE = "record"
OPERATIONS = ("insert", "update", "delete")
SOURCE_TABLES = (
    "cmdb_ci_service_auto",
    "cmdb_ci_server",
    "cmdb_ci_database",
    "cmdb_ci_web_service",
)
ATTESTATION_STATUS = ("Not yet reviewed", "Approved", "Rejected", "Pending")
BUSINESS_CRITICALITY = (
    "1 - most critical",
    "2 - highly critical",
    "3 - moderately critical",
    "4 - not critical",
)
NULL_PERCENT = 30

# Which draw of the row each field uses; numbered fields follow from FIRST_KEY_SLOT.
SLOTS = {
    "operation": 0,
    "source_table": 1,
    "payload_sys_id": 2,
    "asset": 3,
    "asset_tag": 4,
    "assigned_to": 5,
    "attestation_status": 6,
    "business_criticality": 7,
}
FIRST_KEY_SLOT = 8

_DRAWN = "_drawn"
_ROW = "_row"
_POSITION = "_position"


def change_records(
    df: DataFrame,
    row_id: str = "id",
    timestamp_ms: Column | None = None,
    *,
    prefix: str = KEY_PREFIX,
    count: int = KEY_COUNT,
    null_percent: int = NULL_PERCENT,
    seed: int = 0,
    mixed_text: bool = False,
    payload: Mapping[str, Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One nested change record per row of ``df``, shaped like ``change_schema``.

    ``timestamp_ms`` defaults to the time the query runs. ``mixed_text`` draws the
    16-character texts from letters of both cases and digits instead of hex
    digits, for about twice the time. ``payload`` replaces named payload fields by
    columns of ``df``; ``keep`` carries columns along.
    """
    given = dict(payload or {})
    unknown = set(given) - set(NAMED_PAYLOAD_FIELDS)
    if unknown:
        raise ValueError(f"not a named payload field: {', '.join(sorted(unknown))}")
    if timestamp_ms is None:
        timestamp_ms = F.unix_millis(F.current_timestamp())
    if not df.isStreaming:
        # A record costs far more than its id: ids in fewer parts than there are cores
        # are spread over all cores before they are drawn from, in ranges of their
        # position, so that the records keep the order of the rows.
        cores = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = (
                df.withColumn(_POSITION, F.monotonically_increasing_id())
                .repartitionByRange(cores, _POSITION)
                .sortWithinPartitions(_POSITION)
                .drop(_POSITION)
            )

    # The digests are made once per row by one higher-order expression and read
    # by position below; a digest written out per field would exceed the size
    # limit of a generated method.
    drawn = df.select(
        *keep,
        timestamp_ms.cast("bigint").alias("timestamp"),
        *[value.cast("string").alias(f"_{name}") for name, value in given.items()],
        digests(F.col(row_id), FIRST_KEY_SLOT + count, seed).alias(_DRAWN),
    )

    def draw(slot: int) -> Draw:
        return Draw(_DRAWN, slot)

    def characters(slot: int) -> str:
        return draw(slot).mixed_text() if mixed_text else draw(slot).text()

    def text(slot: int) -> str:
        return draw(slot).or_null(characters(slot), null_percent)

    def pooled(slot: int, pool: Sequence[str]) -> str:
        return draw(slot).or_null(draw(slot).pick(pool), null_percent)

    named = {
        "aliases": "cast(NULL AS string)",
        "asset": text(SLOTS["asset"]),
        "asset_tag": text(SLOTS["asset_tag"]),
        "assigned_to": text(SLOTS["assigned_to"]),
        "attestation_status": pooled(SLOTS["attestation_status"], ATTESTATION_STATUS),
        "business_criticality": pooled(SLOTS["business_criticality"], BUSINESS_CRITICALITY),
    }
    named.update({name: sql_name(f"_{name}") for name in given})
    numbered = {
        name: text(FIRST_KEY_SLOT + i) for i, name in enumerate(key_names(prefix, count))
    }
    envelope = {
        "type": sql_text(RECORD_TYPE),
        "operation": draw(SLOTS["operation"]).pick(OPERATIONS),
        "source_table": draw(SLOTS["source_table"]).pick(SOURCE_TABLES),
        "payload_sys_id": characters(SLOTS["payload_sys_id"]),
        "timestamp": sql_name("timestamp"),
    }
    record = {**envelope, PAYLOAD: _struct({**named, **numbered})}

    # The row is made as one struct and unnested by a generator, because the
    # optimizer does not merge a generator with the caller's projection or copy it
    # into the caller's filter. Merged, the fields and their use become one
    # generated method that is too long for the JVM to compile.
    row = F.expr(_struct(record)).alias(_ROW)
    return drawn.select(*keep, row).select(*keep, F.inline(F.array(_ROW)))


def line_bytes(
    df: DataFrame,
    timestamp_ms: Column | None = None,
    *,
    prefix: str = KEY_PREFIX,
    count: int = KEY_COUNT,
    null_percent: int = NULL_PERCENT,
    payload: Mapping[str, Column] | None = None,
) -> float:
    """Mean size of the encoded lines that ``change_records`` makes of a batch, line ends counted, without drawing them.

    What is drawn has sizes that follow from its pool and the share of NULLs; what comes from
    ``df``, times and given payload columns, is measured over all rows.
    """
    if timestamp_ms is None:
        timestamp_ms = F.unix_millis(F.current_timestamp())
    given = {"timestamp": timestamp_ms.cast("bigint")}
    given.update({name: value.cast("string") for name, value in (payload or {}).items()})
    around = len('{"v":}')
    sizes = [F.octet_length(to_json_line(value.alias("v"))) - around for value in given.values()]
    measured = {name: mean or 0.0 for name, mean in zip(given, df.select(*[F.avg(size) for size in sizes]).first())}

    def mean(pool: Sequence[str]) -> float:
        return len('""') + sum(len(item.encode()) for item in pool) / len(pool)

    def or_null(size: float) -> float:
        return (null_percent * len("null") + (100 - null_percent) * size) / 100

    text = len('""') + TEXT_LENGTH
    envelope = {
        "type": mean([RECORD_TYPE]),
        "operation": mean(OPERATIONS),
        "source_table": mean(SOURCE_TABLES),
        "payload_sys_id": text,
    }
    fields = {
        "aliases": len("null"),
        "attestation_status": or_null(mean(ATTESTATION_STATUS)),
        "business_criticality": or_null(mean(BUSINESS_CRITICALITY)),
        **{name: or_null(text) for name in ("asset", "asset_tag", "assigned_to", *key_names(prefix, count))},
    }
    values = {**envelope, **fields, **measured}
    names = sum(len(json.dumps(name, ensure_ascii=False).encode()) + len(":") for name in (*values, PAYLOAD))
    # Two objects, so as many commas as fields, ``data`` not counted, less one.
    return names + sum(values.values()) + len(values) - 1 + len("{{}}\n")


def _struct(fields: Mapping[str, str]) -> str:
    return f"struct({', '.join(f'{value} AS {sql_name(name)}' for name, value in fields.items())})"


def change_stream(spark: SparkSession, rows_per_second: int = 1, **options) -> DataFrame:
    """An unbounded stream of change records, stamped with the time each is due."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return change_records(
        ticks, row_id="value", timestamp_ms=F.unix_millis("timestamp"), **options
    )
