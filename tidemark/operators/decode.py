"""Tolerant decode of JSON change records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.json_text import STRICT_JSON, is_json_object

_CORRUPT = "_unparsed"
_REJECTED = "rejected"


def _as_text(schema: T.StructType) -> T.StructType:
    """The schema to parse with: scalars that need a conversion are read as text."""
    fields = []
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType):
            for inner in field.dataType.fields:
                if not isinstance(inner.dataType, T.StringType):
                    raise ValueError(f"{field.name}.{inner.name} must be a string")
            fields.append(field)
        else:
            fields.append(T.StructField(field.name, T.StringType()))
    return T.StructType(fields)


def decode_changes(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    keep: Sequence[str] = (),
    rejects: bool = False,
) -> DataFrame:
    """Parse ``value`` against ``schema``: one output row per JSON object.

    * a record that is not a JSON object gives no row;
    * a missing field, or a field that does not fit its type, is NULL and the row stays;
    * unknown fields are ignored; names match case-sensitively.

    With ``rejects`` a record that is not a JSON object gives a row as well, with NULL fields
    and its text in a last column ``rejected``, NULL for all others; a NULL value is the
    empty text there.

    Columns named in ``keep`` are carried along. The parse, the gate and the
    unnesting are one generator over a one-element array. Written as a column and
    a filter, the optimizer would push the filter below the projection, and with
    it a second copy of the parse.

    ``from_json`` marks a record as corrupt both when the whole text is bad and
    when one field is; only those marked records are looked at again, to see
    whether their root is an object.
    """
    own = {_CORRUPT, _REJECTED} if rejects else {_CORRUPT}
    taken = (own & set(schema.names)) | (set(keep) & {*own, *schema.names})
    if taken:
        raise ValueError(f"column names taken: {', '.join(sorted(taken))}")
    parse_schema = T.StructType(
        [*_as_text(schema).fields, T.StructField(_CORRUPT, T.StringType())]
    )
    parsed = F.from_json(
        F.col(value), parse_schema, {**STRICT_JSON, "columnNameOfCorruptRecord": _CORRUPT}
    )
    def is_object(row: Column) -> Column:
        return row.isNotNull() & (row[_CORRUPT].isNull() | is_json_object(F.col(value)))

    if rejects:
        names = [field.name for field in parse_schema.fields if field.name != _CORRUPT]
        text = F.coalesce(F.col(value), F.lit(""))
        rows = F.transform(
            F.array(parsed),
            lambda row: F.when(is_object(row), F.struct(*[row[n].alias(n) for n in names], F.lit(None).cast("string").alias(_REJECTED)))
            .otherwise(F.struct(*[F.lit(None).cast(parse_schema[n].dataType).alias(n) for n in names], text.alias(_REJECTED))),
        )
    else:
        rows = F.filter(F.array(parsed), is_object)
    typed = [
        F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.StructType))
        else F.col(field.name).try_cast(field.dataType).alias(field.name)
        for field in schema.fields
    ]
    return df.select(*keep, F.inline(rows)).select(*keep, *typed, *([_REJECTED] if rejects else []))
