"""Files in one folder per value of some columns, however uneven the values are.

Rows are shuffled by those columns, and the sizes that the shuffle measured decide about the
writing tasks: a value with most of the rows is read by several of them, small values share
one (Spark's ``rebalance``). Nobody counts values beforehand, no value needs to be known, and
a row's task follows from its value and from the task that read it, so a task run again
writes the same rows. A task sorts its rows by folder and has one file open at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.rolling import RollingPolicy
from tidemark.sinks.versions import _ended
from tidemark.streaming.control import StreamControl

FOLDER = "by_"
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARALLEL_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


@contextmanager
def _task_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Writing tasks of about ``size`` shuffled bytes, small ones put together; the session's own settings come back afterwards."""
    wanted = {TASK_BYTES: str(size), PARALLEL_FIRST: "false"}
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def land_by_value(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    control: StreamControl | None = None,
    policy: RollingPolicy = RollingPolicy(),
    file_format: str = "json",
    **options: str,
) -> StreamingQuery | None:
    """Write rows to folders ``by_<column>=<value>`` below ``path``/batch=N; a batch frame is batch 0.

    All columns stay in the rows, for the name of a folder is text and cannot tell an empty
    text from null: both are in Spark's default folder. A task reads about
    ``policy.max_part_bytes`` of shuffled rows, which are compressed and so smaller than
    text files; ``policy.record_bytes``, if told, bounds each file as well. A batch's folder
    is replaced as a whole when the batch is run again. ``spark.sql.adaptive.enabled`` must be
    on, as it is unless turned off. A stream is started and its query returned.
    """
    if not by:
        raise ValueError("name at least one column")
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        raise ValueError("values cannot be spread by their sizes without spark.sql.adaptive.enabled")
    folders = [F.col(f"`{name}`").alias(FOLDER + name) for name in by]
    if file_format == "json":
        options = {"ignoreNullFields": "false", **options}

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.select("*", *folders).hint("rebalance", *[F.col(f"`{FOLDER}{name}`") for name in by])
        writer = rows.write.format(file_format).mode("overwrite").options(**{**policy.options(), **options})
        with _task_bytes(batch.sparkSession, policy.max_part_bytes):
            writer.partitionBy(*[FOLDER + name for name in by]).save(f"{path}/batch={number}")

    if not df.isStreaming:
        write(df, 0)
        return None
    if control is None:
        raise ValueError("a stream needs a StreamControl")
    return control.configure(df.writeStream.foreachBatch(write)).start()


def landed_by_value(
    spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], file_format: str = "json"
) -> DataFrame:
    """What ``land_by_value`` has written in batches that have ended, with the folders' names as text columns.

    A filter on a folder's column reads that folder only.
    """
    named = T.StructType([*schema.fields, *[T.StructField(FOLDER + name, T.StringType()) for name in by]])
    done = [f"{path}/batch={number}" for number in _ended(spark, path)]
    if not done:
        return spark.createDataFrame([], named)
    parts = [spark.read.schema(named).format(file_format).option("basePath", folder).load(folder) for folder in done]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows
