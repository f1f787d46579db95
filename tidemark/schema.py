"""Declared shapes of the change record: nested as it arrives, flat as it lands.

Schemas are fixed and declared, never inferred: inference would read the input
twice, and on a stream it would let the first batch decide the columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The names and order of the record's fields.
ENVELOPE_FIELDS = ("type", "operation", "source_table", "payload_sys_id", "timestamp")
NAMED_PAYLOAD_FIELDS = (
    "aliases",
    "asset",
    "asset_tag",
    "assigned_to",
    "attestation_status",
    "business_criticality",
)
PAYLOAD = "data"
KEY_PREFIX = "key_"
KEY_COUNT = 125


def key_names(prefix: str = KEY_PREFIX, count: int = KEY_COUNT) -> list[str]:
    """Names of the numbered payload fields: ``prefix1 … prefixN``."""
    if count < 0:
        raise ValueError(f"count must not be negative, got {count}")
    return [f"{prefix}{i}" for i in range(1, count + 1)]


def payload_names(prefix: str = KEY_PREFIX, count: int = KEY_COUNT) -> list[str]:
    return [*NAMED_PAYLOAD_FIELDS, *key_names(prefix, count)]


def _envelope() -> list[T.StructField]:
    return [
        T.StructField(name, T.LongType() if name == "timestamp" else T.StringType())
        for name in ENVELOPE_FIELDS
    ]


def _strings(names: Iterable[str]) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def change_schema(prefix: str = KEY_PREFIX, count: int = KEY_COUNT) -> T.StructType:
    """The nested record: five scalars and one ``data`` struct of strings."""
    payload = T.StructType(_strings(payload_names(prefix, count)))
    return T.StructType([*_envelope(), T.StructField(PAYLOAD, payload)])


def flat_schema(prefix: str = KEY_PREFIX, count: int = KEY_COUNT) -> T.StructType:
    """The flat record: the five scalars, then every payload field."""
    return T.StructType([*_envelope(), *_strings(payload_names(prefix, count))])


def narrow(schema: T.StructType, *paths: str) -> T.StructType:
    """Keep only the named fields (``"type"``, ``"data.asset"``), in schema order.

    Spark prunes the schema of a ``from_json`` call only when the call has no
    options, and the tolerant decode needs options. Decoding against a narrowed
    schema is the same pruning said explicitly: the parser walks past the fields
    that are not listed without building values for them.
    """
    wanted: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        wanted.setdefault(head, []).append(rest)
    unknown = set(wanted) - set(schema.names)
    if unknown:
        raise ValueError(f"no such field: {', '.join(sorted(unknown))}")
    kept = []
    for field in schema.fields:
        if field.name not in wanted:
            continue
        nested = wanted[field.name]
        if "" in nested:
            kept.append(field)
            continue
        if not isinstance(field.dataType, T.StructType):
            raise ValueError(f"{field.name} has no nested fields")
        kept.append(T.StructField(field.name, narrow(field.dataType, *nested), field.nullable))
    return T.StructType(kept)
