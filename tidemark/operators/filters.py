"""Row filters over raw JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions.json_text import has_keys

# The keys an event/message record must have.
EVENT_KEYS = ("eventTime", "message")


def require_keys(df: DataFrame, *keys: str, value: str = "value") -> DataFrame:
    """Keep records that are JSON objects with all ``keys`` at the top level.

    The text itself is not changed. Without arguments the keys of an
    event/message record are asked for.
    """
    return df.where(has_keys(value, *(keys or EVENT_KEYS)))
