import pytest
from pyspark.sql import types as T

from tidemark.schema import (
    change_schema,
    flat_schema,
    key_names,
    narrow,
    payload_names,
)


def test_column_counts():
    schema = change_schema()
    assert len(schema.fields) == 6
    assert len(schema["data"].dataType.fields) == 131
    assert len(flat_schema().fields) == 136


def test_types():
    schema = change_schema()
    assert schema["timestamp"].dataType == T.LongType()
    assert {f.dataType for f in schema["data"].dataType.fields} == {T.StringType()}
    assert all(f.nullable for f in flat_schema().fields)


def test_generated_names():
    assert key_names("f", 3) == ["f1", "f2", "f3"]
    assert key_names(count=0) == []
    assert payload_names()[-1] == "key_125"
    assert flat_schema("x_", 2).names[-2:] == ["x_1", "x_2"]
    with pytest.raises(ValueError):
        key_names(count=-1)


def test_flat_order_follows_nested_order():
    nested = change_schema()
    assert flat_schema().names == nested.names[:5] + nested["data"].dataType.names


def test_narrow():
    small = narrow(change_schema(), "data.key_2", "type", "data.asset")
    assert small.names == ["type", "data"]
    assert small["data"].dataType.names == ["asset", "key_2"]
    assert narrow(change_schema(), "data") == T.StructType([change_schema()["data"]])
    for wrong in ("nothing", "data.nothing", "type.inner"):
        with pytest.raises(ValueError):
            narrow(change_schema(), wrong)
