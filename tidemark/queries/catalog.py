"""Every registered query: a Spark callable and, beside it, the SQL it must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.sql import sql_name, sql_text
from tidemark.operators.decode import decode_changes
from tidemark.operators.encode import encode_rows
from tidemark.operators.event_time import END, START, first_within, interval_join, sessions, sliding, tumbling
from tidemark.operators.filters import require_keys
from tidemark.operators.generate import change_records, line_bytes
from tidemark.operators.latest import latest
from tidemark.operators.patterns import anomalies, merged, moments, sequences
from tidemark.operators.project import (
    flatten,
    flatten_generated,
    project_envelope,
    project_nested,
)
from tidemark.plans.config import FlatLandingJob, LandingJob
from tidemark.plans.jobs import generate_changes, land_filtered, land_flat_json, land_raw
from tidemark.queries import inputs, oracle
from tidemark.schema import (
    ENVELOPE_FIELDS,
    NAMED_PAYLOAD_FIELDS,
    PAYLOAD,
    change_schema,
    flat_schema,
    narrow,
)
from tidemark.sinks.files import RANDOM_DIGITS, land_json, land_text
from tidemark.sinks.partitioned import land_by_value, landed_by_value
from tidemark.sinks.rolling import MIB, RollingPolicy
from tidemark.sinks.tables import create_json_table, insert_select
from tidemark.sinks.versions import KEPT, REJECTED, keep_snapshot, land_with_rejects, landed, snapshot
from tidemark.sources.files import json_rows, text_values
from tidemark.sources.kafka import utf8_text
from tidemark.sources.views import source_view
from tidemark.streaming.control import StreamControl, finish
from tidemark.streaming.workspace import workspace

ID = inputs.EVENT_MESSAGE_ID
FEW_KEYS = 10


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spread_table(spark, sf_dir, "events", *inputs.EVENT_COLUMNS)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table_stream(spark, sf_dir, "events", *inputs.EVENT_COLUMNS)


# Decoding, batch.


def json_table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = narrow(change_schema(), *ENVELOPE_FIELDS, "data.asset", "data.assigned_to")
    rows = decode_changes(inputs.change_messages(_events(spark, sf_dir)), schema)
    return rows.select(*ENVELOPE_FIELDS, "data.asset", "data.assigned_to")


def json_missing_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = [*NAMED_PAYLOAD_FIELDS, "key_1", "key_125"]
    schema = narrow(change_schema(), *ENVELOPE_FIELDS, *[f"data.{name}" for name in fields])
    rows = decode_changes(inputs.sparse_messages(_events(spark, sf_dir)), schema, keep=(ID,))
    return rows.select(ID, *ENVELOPE_FIELDS, *[f"data.{name}" for name in fields])


def json_skip_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = narrow(change_schema(), *ENVELOPE_FIELDS)
    messages = inputs.damaged_messages(_events(spark, sf_dir))
    return project_envelope(decode_changes(messages, schema, keep=(ID,)), keep=(ID,))


def json_bad_field_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = narrow(change_schema(), *ENVELOPE_FIELDS, "data.asset", "data.key_1")
    messages = inputs.damaged_messages(_events(spark, sf_dir))
    rows = decode_changes(messages, schema, keep=(ID,))
    return rows.select(ID, *ENVELOPE_FIELDS, "data.asset", "data.key_1")


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_rows(inputs.event_changes(_events(spark, sf_dir)), keep=(ID,))


def document_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "text", "lang", "source", "n_chars")
    documents = inputs.table(spark, sf_dir, "documents", *fields)
    return decode_changes(encode_rows(documents), documents.schema).select(*fields)


# Projections, batch.


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = narrow(change_schema(), *ENVELOPE_FIELDS)
    return project_envelope(
        decode_changes(inputs.change_messages(_events(spark, sf_dir)), schema)
    )


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = narrow(change_schema(), *[f"data.{name}" for name in NAMED_PAYLOAD_FIELDS])
    rows = decode_changes(inputs.change_messages(_events(spark, sf_dir)), schema, keep=(ID,))
    return project_nested(rows, keep=(ID,))


def flatten_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(decode_changes(inputs.change_messages(_events(spark, sf_dir)), change_schema()))


def generated_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.change_messages(_events(spark, sf_dir))
    return flatten_generated(decode_changes(messages, change_schema()))


def generated_columns_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.change_messages(_events(spark, sf_dir))
    rows = decode_changes(messages, change_schema(count=FEW_KEYS))
    return flatten_generated(rows, count=FEW_KEYS)


# Key filter, batch.


def json_has_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return require_keys(inputs.event_messages(events)).select("value")


def json_has_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events")
    return require_keys(inputs.null_valued_messages(events)).select(ID)


# Landing, as streams that end when the table is done.


def _job(spark: SparkSession, purpose: str, **settings) -> dict[str, object]:
    root = workspace(spark, purpose)
    return {
        "output_path": f"{root}/landed",
        "checkpoint": f"{root}/checkpoint",
        "available_now": True,
        **settings,
    }


def raw_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = inputs.table_stream(spark, sf_dir, "events", "props").select(
        F.col("props").alias("value")
    )
    job = LandingJob(**_job(spark, "raw_passthrough"))
    finish(land_raw(spark, job, values))
    return text_values(spark, job.output_path)


def raw_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = inputs.table_stream(spark, sf_dir, "documents", "text").select(
        F.col("text").alias("value")
    )
    job = LandingJob(**_job(spark, "raw_multiline"))
    finish(land_raw(spark, job, values))
    return text_values(spark, job.output_path)


def rolled_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = inputs.table_stream(spark, sf_dir, "documents", "text").select(
        F.col("text").alias("value")
    )
    policy = RollingPolicy(max_part_bytes=MIB, by_bytes=True)
    job = LandingJob(**_job(spark, "rolled_landing"), policy=policy)
    finish(land_raw(spark, job, values))
    return text_values(spark, job.output_path).select("value")


def _user_changes(messages: DataFrame) -> DataFrame:
    schema = narrow(change_schema(), "timestamp", "operation", "data.asset", "data.assigned_to")
    rows = decode_changes(messages, schema, keep=(ID,))
    return rows.select(ID, "timestamp", "operation", "data.asset", "data.assigned_to")


def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _user_changes(inputs.change_messages(_events(spark, sf_dir)))
    return latest(changes, "assigned_to", ("timestamp", ID))


def latest_state_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _user_changes(inputs.change_messages(_event_stream(spark, sf_dir)))
    root = workspace(spark, "latest_state_stream")
    control = StreamControl(f"{root}/checkpoint", available_now=True)
    finish(keep_snapshot(changes, f"{root}/state", control, "assigned_to", ("timestamp", ID)))
    return snapshot(spark, f"{root}/state", changes.schema)


def rejects_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.damaged_messages(_event_stream(spark, sf_dir))
    root = workspace(spark, "rejects_landing")
    control = StreamControl(f"{root}/checkpoint", available_now=True)
    schema = narrow(change_schema(), *ENVELOPE_FIELDS)
    finish(land_with_rejects(messages, schema, f"{root}/landed", control, keep=(ID,)))
    names = [messages.schema[ID], T.StructField("type", T.StringType())]
    both = [
        landed(spark, f"{root}/landed", T.StructType(names), outcome).select(ID, F.lit(outcome).alias("outcome"), "type")
        for outcome in (KEPT, REJECTED)
    ]
    return both[0].union(both[1])


def partitioned_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.table_stream(spark, sf_dir, "events", "event_id", "event_type", "props")
    root = workspace(spark, "partitioned_landing")
    control = StreamControl(f"{root}/checkpoint", available_now=True)
    finish(land_by_value(rows, f"{root}/landed", ["event_type"], control))
    return landed_by_value(spark, f"{root}/landed", rows.schema, ["event_type"])


def filtered_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.event_messages(inputs.table_stream(spark, sf_dir, "events"))
    job = LandingJob(**_job(spark, "filtered_landing"))
    finish(land_filtered(spark, job, messages.select("value")))
    return text_values(spark, job.output_path)


def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = inputs.damaged_messages(_event_stream(spark, sf_dir))
    # A gzip file is read by one task, so the stream is told about the size of its lines and rolls its files by it.
    policy = RollingPolicy(record_bytes=inputs.event_line_bytes(_events(spark, sf_dir)))
    job = FlatLandingJob(**_job(spark, "json_landing"), policy=policy, compression="gzip")
    finish(land_flat_json(spark, job, messages.select("value")))
    return json_rows(spark, job.output_path, flat_schema())


def document_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("doc_id", "text", "lang", "source", "n_chars")
    documents = inputs.table_stream(spark, sf_dir, "documents", *fields)
    job = LandingJob(**_job(spark, "document_landing"))
    finish(land_json(documents, job.output_path, job.control("document_landing"), job.policy))
    return json_rows(spark, job.output_path, documents.schema)


def insert_select_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    job = LandingJob(**_job(spark, "insert_select"))
    suffix = job.output_path.split("/")[-2].rsplit("-", 1)[1]
    source, sink = f"changes_{suffix}", f"landed_{suffix}"
    sink_schema = T.StructType(
        [
            T.StructField("change_type", T.StringType()),
            T.StructField("change_operation", T.StringType()),
            T.StructField("changed_at", T.LongType()),
            T.StructField("asset_name", T.StringType()),
            T.StructField("last_key", T.StringType()),
        ]
    )
    columns = ["type", "operation", "timestamp", "data.asset", "data.key_125"]
    messages = inputs.damaged_messages(_event_stream(spark, sf_dir))
    source_view(messages, source, change_schema(), columns=columns)
    create_json_table(spark, sink, sink_schema, job.output_path)
    query = f"SELECT type, operation, `timestamp`, data.asset, data.key_125 FROM {source}"
    try:
        finish(insert_select(spark, sink, query, job.control(sink), job.policy))
    finally:
        spark.catalog.dropTempView(source)
        spark.sql(f"DROP TABLE IF EXISTS {sink}")
    return json_rows(spark, job.output_path, sink_schema)


def sql_source_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over a source declared with all its columns, of which two are parsed."""
    name = f"changes_{uuid.uuid4().hex}"
    messages = inputs.damaged_messages(_events(spark, sf_dir))
    source_view(messages, name, change_schema(), columns=["type", "data.asset"])
    try:
        return spark.sql(f"SELECT type, data.asset FROM {name}")
    finally:
        spark.catalog.dropTempView(name)


def restart_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run finds the first half of the table landed already, and the other half new."""
    job = LandingJob(**_job(spark, "restart_no_duplicates"))
    inbox = f"{workspace(spark, 'restart_inbox')}/values"
    half = F.pmod(F.xxhash64(ID), F.lit(2))
    for part in range(2):
        props = inputs.table(spark, sf_dir, "events", ID, "props").where(half == part)
        land_text(props.select(F.col("props").alias("value")), inbox)
        finish(land_raw(spark, job, text_values(spark, inbox, streaming=True)))
    return text_values(spark, job.output_path).groupBy("value").agg(F.count("*").alias("n"))


# Event time, as streams. Windows that the last watermark has not passed stay open and are not in the result.

DELAY = "1 hour"


def _timed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.timed_events(_event_stream(spark, sf_dir))


def _ended(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    """What the stream ``rows`` gives until the table is done."""
    root = workspace(spark, purpose)
    control = StreamControl(f"{root}/checkpoint", available_now=True)
    finish(control.configure(rows.writeStream.format("parquet").option("path", f"{root}/rows")).start())
    return spark.read.schema(rows.schema).parquet(f"{root}/rows")


def _windows(rows: DataFrame, *names: str) -> DataFrame:
    return rows.select(F.unix_micros(START).alias("start_us"), F.unix_micros(END).alias("end_us"), *names)


def window_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = [F.min(ID).alias("least_id"), F.sum("user_id").alias("user_sum")]
    rows = tumbling(_timed_stream(spark, sf_dir), "at", "6 hours", DELAY, ["event_type"], totals)
    return _windows(_ended(spark, rows, "window_tumbling"), "event_type", "n", "least_id", "user_sum")


def window_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sliding(_timed_stream(spark, sf_dir), "at", "6 hours", "2 hours", DELAY, ["event_type"])
    return _windows(_ended(spark, rows, "window_sliding"), "event_type", "n")


def window_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = [F.max(ID).alias("greatest_id")]
    rows = sessions(_timed_stream(spark, sf_dir), "at", "12 hours", DELAY, ["user_id"], totals)
    return _windows(_ended(spark, rows, "window_session"), "user_id", "n", "greatest_id")


def repeats_within_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event is delivered twice and comes out once."""
    twice = _timed_stream(spark, sf_dir).select(ID, "at", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    rows = _ended(spark, first_within(twice, [ID], "at", DELAY), "repeats_within_horizon")
    return rows.select(ID, F.unix_micros("at").alias("at_us"))


def stream_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases up to 6 hours after a click of the same user."""
    events = _timed_stream(spark, sf_dir)

    def side(kind: str) -> DataFrame:
        rows = events.where(F.col("event_type") == kind)
        return rows.select(F.col(ID).alias(f"{kind}_id"), F.col("user_id").alias(f"{kind}_user"), F.col("at").alias(f"{kind}_at"))

    keys = [("click_user", "purchase_user")]
    pairs = interval_join(side("click"), side("purchase"), keys, "click_at", "purchase_at", "0 hours", "6 hours", DELAY)
    rows = _ended(spark, pairs, "stream_interval_join")
    wait = (F.unix_micros("purchase_at") - F.unix_micros("click_at")).alias("wait_us")
    return rows.select("click_id", "purchase_id", wait)


# Sequences and outliers, batch.


def pattern_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A click, a view after it and a purchase after that, of one user within 2 days."""
    events = inputs.timed_events(inputs.table(spark, sf_dir, "events"))
    steps = [f"event_type = '{kind}'" for kind in ("click", "view", "purchase")]
    return sequences(events, "user_id", "at", ID, steps, timedelta(days=2))


def pattern_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two errors of one user, one right after the other, within a day."""
    events = inputs.timed_events(inputs.table(spark, sf_dir, "events"))
    return sequences(events, "user_id", "at", ID, ["event_type = 'error'"] * 2, timedelta(days=1), strict=True)


def event_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments per kind, merged from those per kind and user."""
    events = inputs.table(spark, sf_dir, "events", "event_type", "user_id", "value")
    rows = merged(moments(events, ["event_type", "user_id"], "value", "0.01"), ["event_type"])
    return rows.select("event_type", "n", F.col("s").cast("long").alias("s"), F.col("q").cast("string").alias("q"))


def anomalous_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values over 3 deviations from those of their kind in the 7 days before."""
    events = inputs.timed_events(inputs.table(spark, sf_dir, "events"), "value")
    rows = anomalies(events, "event_type", "at", "value", timedelta(days=1), 7, 3, "0.01", least=10)
    return rows.select(ID, "event_type", "past_n")


# Bytes.


def bytes_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents", "doc_id", "text")
    return inputs.cut_bytes(documents).select(
        "doc_id",
        F.substring(utf8_text("value", "replace"), -1, 1).alias("replaced_end"),
        utf8_text("value", "null").alias("valid_text"),
        F.octet_length(utf8_text("value", "keep")).alias("kept_bytes"),
    )


# Generation.

GENERATED_BASE_MS = 1_700_000_000_000
GENERATED_SEED = 7


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.spread_table(spark, sf_dir, "orders", "o_orderkey")


def _order_stamp() -> Column:
    return F.lit(GENERATED_BASE_MS) + F.col("o_orderkey")


def _order_changes(orders: DataFrame) -> DataFrame:
    return change_records(orders, row_id="o_orderkey", timestamp_ms=_order_stamp(), seed=GENERATED_SEED)


def gen_change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(_order_changes(_orders(spark, sf_dir)))


def gen_mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = change_records(
        _orders(spark, sf_dir), row_id="o_orderkey", timestamp_ms=F.col("o_orderkey"), mixed_text=True
    )
    return flatten(rows)


def gen_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{workspace(spark, 'gen_landing')}/landed"
    orders = _orders(spark, sf_dir)
    # The lines are made once: their mean size is told, not measured on lines made for it.
    policy = RollingPolicy(record_bytes=line_bytes(orders, _order_stamp()))
    # Generated values are random: gzip lands them in about 0.4 of the plain size.
    land_text(encode_rows(_order_changes(orders)), path, policy=policy, compression="gzip", codec=RANDOM_DIGITS)
    return flatten(decode_changes(text_values(spark, path), change_schema()))


def gen_job_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The generator job itself, one record per order; its lines land in 0.4 to 0.5 of their plain size."""
    job = LandingJob(f"{workspace(spark, 'gen_job')}/landed", compression="gzip")
    generate_changes(
        spark,
        job=job,
        ids=_orders(spark, sf_dir),
        row_id="o_orderkey",
        timestamp_ms=F.col("o_orderkey"),
        seed=0,
    )
    return flatten(decode_changes(text_values(spark, job.output_path), change_schema()))


def gen_null_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.event_changes(_events(spark, sf_dir)).select(f"{PAYLOAD}.*")
    counts = changes.selectExpr(
        *[f"count_if({sql_name(name)} IS NULL) AS {sql_name(name)}" for name in changes.columns]
    )
    # One row by now. ``unpivot`` gives the same rows, seconds slower at this width.
    pairs = [
        f"struct({sql_text(name)} AS key, {sql_name(name)} AS null_count)"
        for name in counts.columns
    ]
    return counts.selectExpr(f"inline(array({', '.join(pairs)}))")


def _sql_gen_changes() -> str:
    fields = oracle.record(f"{GENERATED_BASE_MS} + o_orderkey", {})
    return oracle.select(fields, oracle.drawn("orders", "o_orderkey", seed=GENERATED_SEED))


def _sql_gen_mixed() -> str:
    fields = oracle.record("o_orderkey", {}, mixed=True)
    return oracle.select(fields, oracle.drawn("orders", "o_orderkey"))


def _sql_events(names, where: str | None = None) -> str:
    return oracle.select(oracle.event_record(), oracle.EVENTS, names, where)


def _sql_damaged(names) -> str:
    return oracle.select(oracle.damaged_record(), oracle.EVENTS, names, oracle.DAMAGED_ROWS)


def _sql_sparse() -> str:
    fields = oracle.event_record()
    names = [*ENVELOPE_FIELDS, *NAMED_PAYLOAD_FIELDS, "key_1", "key_125"]
    for name in names[len(ENVELOPE_FIELDS):]:
        fields[name] = f"CASE WHEN {oracle.KIND} >= '8' THEN {fields[name]} END"
    return oracle.select(fields, oracle.EVENTS, [ID, *names])


def _sql_inserted() -> str:
    fields = oracle.damaged_record()
    names = {
        "change_type": "type",
        "change_operation": "operation",
        "changed_at": "timestamp",
        "asset_name": "asset",
        "last_key": "key_125",
    }
    renamed = {sink: fields[source] for sink, source in names.items()}
    return oracle.select(renamed, oracle.EVENTS, where=oracle.DAMAGED_ROWS)


def _sql_latest() -> str:
    rows = _sql_events([ID, "timestamp", "operation", "asset", "assigned_to"])
    return (
        f"SELECT * FROM ({rows}) WHERE assigned_to IS NOT NULL QUALIFY row_number() OVER"
        f" (PARTITION BY assigned_to ORDER BY timestamp DESC NULLS LAST, {ID} DESC) = 1"
    )


def _sql_rejects() -> str:
    return (
        f"SELECT {ID}, 'kept' AS outcome, type FROM ({_sql_damaged([ID, 'type'])}) UNION ALL"
        f" SELECT {ID}, 'rejected', NULL FROM events WHERE NOT ({oracle.DAMAGED_ROWS})"
    )


_DOCUMENTS_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents"
_FEW_FLAT = [*ENVELOPE_FIELDS, *NAMED_PAYLOAD_FIELDS, *[f"key_{i}" for i in range(1, FEW_KEYS + 1)]]

CATALOG: dict[str, Query] = {
    "raw_passthrough": Query(raw_passthrough, "SELECT props AS value FROM events"),
    "raw_multiline_passthrough": Query(
        raw_multiline, "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"
    ),
    "rolled_landing": Query(
        rolled_landing, "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"
    ),
    "partitioned_landing": Query(
        partitioned_landing, "SELECT event_id, event_type, props, nullif(event_type, '') AS by_event_type FROM events"
    ),
    "latest_state": Query(latest_state, _sql_latest()),
    "latest_state_stream": Query(latest_state_stream, _sql_latest()),
    "rejects_landing": Query(rejects_landing, _sql_rejects()),
    "window_tumbling": Query(window_tumbling, oracle.tumbling()),
    "window_sliding": Query(window_sliding, oracle.sliding()),
    "window_session": Query(window_session, oracle.sessions()),
    "repeats_within_horizon": Query(
        repeats_within_horizon, "SELECT event_id, epoch_us(ts) AS at_us FROM events WHERE ts IS NOT NULL"
    ),
    "stream_interval_join": Query(stream_interval_join, oracle.interval_join()),
    "pattern_sequence": Query(pattern_sequence, oracle.sequence()),
    "pattern_next": Query(pattern_next, oracle.next_to_each_other()),
    "event_moments": Query(event_moments, oracle.event_moments()),
    "anomalous_values": Query(anomalous_values, oracle.anomalies()),
    "json_table_source": Query(
        json_table_source, _sql_events([*ENVELOPE_FIELDS, "asset", "assigned_to"])
    ),
    "json_missing_field": Query(json_missing_field, _sql_sparse()),
    "json_skip_malformed": Query(json_skip_malformed, _sql_damaged([ID, *ENVELOPE_FIELDS])),
    "json_bad_field_null": Query(
        json_bad_field_null, _sql_damaged([ID, *ENVELOPE_FIELDS, "asset", "key_1"])
    ),
    "json_encode": Query(json_encode, oracle.encoded_events()),
    "json_document_round_trip": Query(document_round_trip, _DOCUMENTS_SQL),
    "project_envelope": Query(envelope, _sql_events(ENVELOPE_FIELDS)),
    "project_nested": Query(nested, _sql_events([ID, *NAMED_PAYLOAD_FIELDS])),
    "flatten_record": Query(flatten_record, _sql_events(oracle.FLAT)),
    "flatten_generated": Query(generated_columns, _sql_events(oracle.FLAT)),
    "flatten_generated_few": Query(generated_columns_few, _sql_events(_FEW_FLAT)),
    "json_has_keys": Query(json_has_keys, oracle.kept_event_messages()),
    "json_has_null_key": Query(
        json_has_null_key, f"SELECT event_id FROM events WHERE {oracle.KIND} < 'c'"
    ),
    "insert_select": Query(insert_select_landing, _sql_inserted()),
    "sql_source_select": Query(sql_source_select, _sql_damaged(["type", "asset"])),
    "filtered_landing": Query(filtered_landing, oracle.kept_event_messages()),
    "json_landing": Query(json_landing, _sql_damaged(oracle.FLAT)),
    "json_document_landing": Query(document_landing, _DOCUMENTS_SQL),
    "restart_no_duplicates": Query(
        restart_no_duplicates, "SELECT props AS value, count(*) AS n FROM events GROUP BY props"
    ),
    "bytes_to_text": Query(bytes_to_text, oracle.cut_texts()),
    "gen_change_records": Query(gen_change_records, _sql_gen_changes()),
    "gen_mixed_text": Query(gen_mixed_text, _sql_gen_mixed()),
    "gen_landing": Query(gen_landing, _sql_gen_changes()),
    "gen_job_landing": Query(gen_job_landing, _sql_gen_mixed()),
    "gen_null_share": Query(gen_null_share, oracle.null_shares()),
}
