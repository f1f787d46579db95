"""Named JSON sink tables and the insert-select that feeds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.json_text import NO_LIMITS
from tidemark.sinks.rolling import RollingPolicy
from tidemark.streaming.control import StreamControl


def create_json_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """Declare a sink table of JSON files at ``path``."""
    spark.catalog.createTable(
        name, path=path, source="json", schema=schema, ignoreNullFields="false", **NO_LIMITS
    )


def by_position(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give ``df`` the sink's column names, first to first; types must agree."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"the query has {len(df.columns)} columns, the sink {len(schema.fields)}")
    for got, want in zip(df.schema.fields, schema.fields):
        if got.dataType != want.dataType:
            raise ValueError(
                f"{got.name} is {got.dataType.simpleString()}, "
                f"the sink's {want.name} is {want.dataType.simpleString()}"
            )
    return df.toDF(*schema.names)


def insert_select(
    spark: SparkSession,
    table: str,
    query: str,
    control: StreamControl | None = None,
    policy: RollingPolicy = RollingPolicy(),
) -> StreamingQuery | None:
    """``INSERT INTO table query``: continuous if the query reads a stream."""
    rows = by_position(spark.sql(query), spark.table(table).schema)
    arranged = policy.arrange(rows)
    options = {**policy.options(), "ignoreNullFields": "false"}
    if not rows.isStreaming:
        arranged.write.format("json").mode("append").options(**options).saveAsTable(table)
        return None
    if control is None:
        raise ValueError("a stream needs a StreamControl")
    writer = arranged.writeStream.format("json").options(**options)
    return control.configure(writer, policy.interval).toTable(table)
