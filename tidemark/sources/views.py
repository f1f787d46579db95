"""Named sources for SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.operators.decode import decode_changes
from tidemark.schema import narrow


def source_view(
    values: DataFrame,
    name: str,
    schema: T.StructType,
    value: str = "value",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Declare JSON ``values`` as a typed source named ``name`` and return it.

    ``columns`` are the fields that queries will use (``"type"``, ``"data.asset"``). A
    view parses every field it declares, so naming them parses no more than those.
    A view over a streaming frame is itself a stream in ``spark.sql``.
    """
    typed = decode_changes(values, narrow(schema, *columns) if columns else schema, value)
    typed.createOrReplaceTempView(name)
    return typed
