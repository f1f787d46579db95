"""Column functions over JSON text.

None of them raises on bad input: text that is not a JSON object gives NULL or
false, so one bad record never fails a batch.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The parser's own limits on depth, digits and text length would drop valid records.
NO_LIMITS = {
    "maxNestingDepth": str(2**31 - 1),
    "maxNumLen": str(2**31 - 1),
    "maxStringLen": str(2**31 - 1),
}

# Only standard JSON counts: no single quotes, no NaN or Infinity tokens.
STRICT_JSON = {
    **NO_LIMITS,
    "mode": "PERMISSIVE",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}


def json_object(value: Column | str) -> Column:
    """Top-level entries as ``map<string,string>``; NULL unless the root is an object."""
    return F.from_json(value, "map<string,string>", STRICT_JSON)


def is_json_object(value: Column | str) -> Column:
    return json_object(value).isNotNull()


def _key_set_has(value: Column, keys: Sequence[str]) -> Column:
    found = F.array_intersect(
        F.map_keys(json_object(value)), F.array(*[F.lit(key) for key in keys])
    )
    return F.size(found) == len(keys)


def has_keys(value: Column | str, *keys: str) -> Column:
    """True when every key is present at the top level, whatever its value.

    A key with a JSON null value is present, which only the full key set can
    tell. Building that set turns every value of the record into text, so the
    asked fields alone are parsed first: if all of them have a value, that
    decides. The key set is needed only for a text in which the word ``null``
    occurs. An asked key whose own value is nested more than a thousand deep is not
    seen: Spark makes no text of it, whatever the options. Both tests share one element of a one-element array, which keeps the
    first parse single.
    """
    if not keys:
        raise ValueError("name at least one key")
    text = F.col(value) if isinstance(value, str) else value
    wanted = sorted(set(keys))
    if len({key.lower() for key in wanted}) < len(wanted):
        # Struct fields cannot be told apart by case alone.
        return reduce(and_, [has_keys(text, key) for key in wanted])
    schema = T.StructType([T.StructField(key, T.StringType()) for key in wanted])

    def present(fields: Column) -> Column:
        valued = reduce(and_, [fields[key].isNotNull() for key in wanted])
        by_key_set = F.contains(text, F.lit("null")) & _key_set_has(text, wanted)
        return valued | F.coalesce(by_key_set, F.lit(False))

    return F.exists(F.array(F.from_json(text, schema, STRICT_JSON)), present)


def to_json_line(*columns: Column | str) -> Column:
    """One compact JSON object per row, with NULL fields written as ``null``."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
