"""Messages built from the given tables, one per table row, nothing left out.

Some messages are damaged on purpose. Which one is decided by the first hex
digit of a hash of the row id, so the kinds are scattered evenly over the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.json_text import to_json_line
from tidemark.functions.sql import sql_name
from tidemark.operators.generate import change_records, line_bytes
from tidemark.schema import ENVELOPE_FIELDS, PAYLOAD
from tidemark.sources.files import parquet_stream

EVENT_MESSAGE_ID = "event_id"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


# Parts a core that even out over all cores, and the most slices that a table of fewer parts is read in.
PARTS_PER_CORE = 4
MOST_SLICES = 64


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The same table, its rows dealt over all cores without a shuffle.

    A row group is read by one task, and a table may have one. What is made of these rows
    costs a thousand times what reading them does, so the table is read as slices, one after
    the other by the rows' place in their file: each reads the few columns and keeps its part.
    """
    whole = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    rows = whole.select(*columns) if columns else whole
    parts = PARTS_PER_CORE * spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= parts:
        return rows
    place = F.col("_metadata.row_index")
    (last,) = whole.select(F.max(place)).first()
    if last is None:
        return rows
    step = last // min(parts, MOST_SLICES) + 1
    slices = [
        whole.where((place >= first) & (place < first + step)).select(*(columns or ["*"]))
        for first in range(0, last + 1, step)
    ]
    # The generator keeps the optimizer from copying what comes next into every slice.
    row = F.struct(*[F.col(sql_name(column)) for column in rows.columns])
    return reduce(DataFrame.unionAll, slices).select(F.inline(F.array(row)))


def table_stream(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The same table as a stream.

    The file source takes a folder or a pattern, not a plain file name; the
    pattern here matches the table whether it is one file or a folder of files.
    """
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    stream = parquet_stream(spark, f"{sf_dir}/{name}.parque[t]", schema)
    return stream.select(*columns) if columns else stream


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970 of a timestamp column, whatever the session's time zone."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        return F.floor(
            F.expr(
                f"cast(cast({name} - timestamp_ntz'1970-01-01 00:00:00' as interval second)"
                " as decimal(20, 6)) * 1000"
            )
        ).cast("bigint")
    return F.unix_millis(name)


def timed_events(events: DataFrame, *more: str) -> DataFrame:
    """Events with their time as ``at``, an instant: their local time, read as UTC; and columns as they are."""
    micros = (
        "cast(cast(cast(ts as timestamp_ntz) - timestamp_ntz'1970-01-01 00:00:00' as interval second)"
        " as decimal(20, 6)) * 1000000"
    )
    return events.select(
        EVENT_MESSAGE_ID, "user_id", "event_type", F.expr(f"timestamp_micros(cast({micros} as bigint))").alias("at"), *more
    )


def kind(row_id: str) -> Column:
    """One hex digit per row, by which damage is chosen."""
    return F.substring(F.md5(F.concat(F.col(row_id).cast("string"), F.lit("#kind"))), 1, 1)


def as_source(df: DataFrame, value: Column) -> DataFrame:
    """``event_id`` and a made-up ``value`` that, like one read from a topic, is just there.

    The generator keeps the optimizer from copying the making of the text into
    whatever filter comes next.
    """
    return df.select(EVENT_MESSAGE_ID, F.explode(F.array(value)).alias("value"))


def _given(events: DataFrame) -> dict[str, object]:
    """What a change record takes from its event."""
    payload = {"asset": F.col("event_type"), "assigned_to": F.col("user_id")}
    return {"timestamp_ms": epoch_millis(events, "ts"), "payload": payload}


def event_changes(events: DataFrame) -> DataFrame:
    """``event_id`` and one change record per event."""
    return change_records(events, row_id=EVENT_MESSAGE_ID, keep=(EVENT_MESSAGE_ID,), **_given(events))


def event_line_bytes(events: DataFrame) -> float:
    """Mean size of the lines that undamaged change records of a batch of events make."""
    return line_bytes(events, **_given(events))


EVENT_COLUMNS = (EVENT_MESSAGE_ID, "ts", "event_type", "user_id")


def change_messages(events: DataFrame) -> DataFrame:
    """``event_id`` and the event's change record as one JSON line."""
    changes = event_changes(events)
    return as_source(changes, to_json_line(*ENVELOPE_FIELDS, PAYLOAD))


def sparse_messages(events: DataFrame) -> DataFrame:
    """As ``change_messages``, but NULL fields are absent, and for half the kinds all of ``data``."""
    changes = event_changes(events)
    payload = F.when(kind(EVENT_MESSAGE_ID) >= "8", F.col(PAYLOAD))
    return as_source(changes, F.to_json(F.struct(*ENVELOPE_FIELDS, payload.alias(PAYLOAD))))


# Valid JSON beyond the usual limits of parsers.
DEEP = "[" * 1100 + "]" * 1100
LONG_NUMBER = "1" * 1100


def damaged_messages(events: DataFrame) -> DataFrame:
    """Change messages of which ten kinds in sixteen are damaged, and two hold what parsers like to limit.

    0 cut off, 1 not JSON, 2 timestamp is text, 3 data is text, 4 no data,
    5 inside an array, 6 unknown fields, 7 blank, 8 timestamp quoted,
    9 timestamp with a fraction; a unknown field 1100 deep, b unknown number of 1100
    digits; others intact.
    """
    parts = event_changes(events).select(
        EVENT_MESSAGE_ID,
        "timestamp",
        kind(EVENT_MESSAGE_ID).alias("kind"),
        to_json_line(*ENVELOPE_FIELDS).alias("head"),
        F.to_json(PAYLOAD, {"ignoreNullFields": "false"}).alias("payload"),
    )
    head, payload, kind_ = F.col("head"), F.col("payload"), F.col("kind")
    number = F.concat(F.lit('"timestamp":'), F.col("timestamp").cast("string"))

    def whole(start: Column, data: Column) -> Column:
        opened = F.left(start, F.length(start) - 1)
        return F.concat(opened, F.lit(f',"{PAYLOAD}":'), data, F.lit("}"))

    def stamped(text: Column) -> Column:
        return F.replace(head, number, F.concat(F.lit('"timestamp":'), text))

    def also(text: str) -> Column:
        return F.concat(F.left(head, F.length(head) - 1), F.lit(f',"zzz":{text}}}'))

    quoted = F.concat(F.lit('"'), F.col("timestamp").cast("string"), F.lit('"'))
    fraction = F.concat(F.col("timestamp").cast("string"), F.lit(".5"))
    unknown = F.concat(F.left(payload, F.length(payload) - 1), F.lit(',"zzz":[1,{"a":2}]}'))
    value = (
        F.when(kind_ == "0", F.left(whole(head, payload), F.length(whole(head, payload)) - 1))
        .when(kind_ == "1", F.lit("not json"))
        .when(kind_ == "2", whole(stamped(F.lit('"n/a"')), payload))
        .when(kind_ == "3", whole(head, F.lit('"oops"')))
        .when(kind_ == "4", head)
        .when(kind_ == "5", F.concat(F.lit("["), whole(head, payload), F.lit("]")))
        .when(kind_ == "6", whole(head, unknown))
        .when(kind_ == "7", F.lit("  "))
        .when(kind_ == "8", whole(stamped(quoted), payload))
        .when(kind_ == "9", whole(stamped(fraction), payload))
        .when(kind_ == "a", whole(also(DEEP), payload))
        .when(kind_ == "b", whole(also(LONG_NUMBER), payload))
        .otherwise(whole(head, payload))
    )
    return as_source(parts, value)


def event_messages(events: DataFrame) -> DataFrame:
    """Event/message records; by kind some lack a key or are not JSON objects.

    0 no message, 1 no eventTime, 2 keys one level down, 3 cut off, 4 inside an
    array, 5 single quotes, 6 bad token, 7 a JSON string, 8 a number,
    9 duplicate key, a field 1100 deep, b number of 1100 digits; others intact.
    """
    parts = events.select(
        EVENT_MESSAGE_ID,
        kind(EVENT_MESSAGE_ID).alias("kind"),
        epoch_millis(events, "ts").cast("string").alias("at"),
        "event_type",
        "props",
    )

    def text(template: str) -> Column:
        return F.format_string(
            template.replace("AT", "%1$s").replace("MSG", "%2$s").replace("PROPS", "%3$s"),
            "at",
            "event_type",
            "props",
        )

    kind_ = F.col("kind")
    value = (
        F.when(kind_ == "0", text('{"eventTime":AT,"props":PROPS}'))
        .when(kind_ == "1", text('{"message":"MSG","props":PROPS}'))
        .when(kind_ == "2", text('{"in":{"eventTime":AT,"message":"MSG"}}'))
        .when(kind_ == "3", text('{"eventTime":AT,"message":"MSG'))
        .when(kind_ == "4", text('[{"eventTime":AT,"message":"MSG"}]'))
        .when(kind_ == "5", text("{'eventTime':AT,'message':'MSG'}"))
        .when(kind_ == "6", text('{"eventTime":AT,"message":"MSG","ok":tru}'))
        .when(kind_ == "7", text('"eventTime message MSG"'))
        .when(kind_ == "8", text("AT"))
        .when(kind_ == "9", text('{"eventTime":0,"eventTime":AT,"message":"MSG"}'))
        .when(kind_ == "a", text(f'{{"eventTime":AT,"message":"MSG","deep":{DEEP}}}'))
        .when(kind_ == "b", text(f'{{"eventTime":AT,"message":"MSG","long":{LONG_NUMBER}}}'))
        .otherwise(text('{"eventTime":AT,"message":"MSG","props":PROPS}'))
    )
    return as_source(parts, value)


def null_valued_messages(events: DataFrame) -> DataFrame:
    """Event/message records whose values are JSON null, or whose key is absent.

    Kinds 0-3 time null, 4-7 message null, 8-b both null, c-d no time, e-f no message.
    The other values, and a further field, are the row's own.
    """
    kind_ = kind(EVENT_MESSAGE_ID)
    parts = events.select(
        EVENT_MESSAGE_ID, epoch_millis(events, "ts").cast("string").alias("at"), "event_type", "props"
    )

    def text(template: str) -> Column:
        template = template.replace("AT", "%1$s").replace("MSG", "%2$s").replace("PROPS", "%3$s")
        return F.format_string(template, "at", "event_type", "props")

    value = (
        F.when(kind_ < "4", text('{"eventTime":null,"message":"MSG","props":PROPS}'))
        .when(kind_ < "8", text('{"eventTime":AT,"message":null,"props":PROPS}'))
        .when(kind_ < "c", text('{"eventTime":null,"message":null,"props":PROPS}'))
        .when(kind_ < "e", text('{"message":"eventTime","in":{"eventTime":AT,"kind":"MSG"},"props":PROPS}'))
        .otherwise(text('{"eventTime":"message","in":{"message":"MSG","at":AT},"props":PROPS}'))
    )
    return as_source(parts, value)


# Which texts lose their last byte, which may be the middle of a character, and gain a byte that is never UTF-8.
CUT = "substr(md5(concat(cast(doc_id AS string), '#cut')), 1, 1) < '8'"


def cut_bytes(documents: DataFrame) -> DataFrame:
    """``doc_id`` and the text as bytes, as a topic delivers it; half of them are not UTF-8."""
    raw = F.expr("cast(text AS binary)")
    spoiled = F.expr("concat(substring(cast(text AS binary), 1, octet_length(text) - 1), X'FF')")
    value = F.when(F.expr(CUT), spoiled).otherwise(raw)
    return documents.select("doc_id", F.explode(F.array(value)).alias("value"))
