"""Files as a source of values or of table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.json_text import NO_LIMITS

# A stream takes at most this many new files into one batch; the rest wait for the next.
FILES_PER_BATCH = 1_000


def text_values(spark: SparkSession, path: str, *, streaming: bool = False, **options) -> DataFrame:
    """One ``value`` per line. Only ``\\n`` ends a line, so a carriage return stays."""
    reader = spark.readStream if streaming else spark.read
    if streaming:
        options = {"maxFilesPerTrigger": FILES_PER_BATCH, **options}
    return (
        reader.schema("value string").format("text").options(lineSep="\n", **options).load(path)
    )


def json_rows(
    spark: SparkSession, path: str, schema: T.StructType, *, streaming: bool = False
) -> DataFrame:
    """Rows of landed JSON files, read with their declared schema."""
    reader = spark.readStream if streaming else spark.read
    return reader.schema(schema).format("json").options(**NO_LIMITS).load(path)


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, **options
) -> DataFrame:
    """The parquet files of a folder or pattern as a stream: each once, new ones as they come."""
    options = {"maxFilesPerTrigger": FILES_PER_BATCH, **options}
    return spark.readStream.schema(schema).format("parquet").options(**options).load(path)
