"""Outputs that a stream writes batch by batch: a snapshot kept up to date, and records with their rejects.

Both write one folder per batch, named by the batch's number, and replace it as a whole. A
batch that is run again after a lost commit gives the same folder again: nothing is twice.
A folder counts when its write has ended (``_SUCCESS``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.decode import decode_changes
from tidemark.operators.latest import KEY, ORDER, latest, merge_latest
from tidemark.streaming.control import StreamControl

KEPT = "kept"
REJECTED = "rejected"


def _ended(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches whose folder below ``path`` is complete."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS"))
    names = [status.getPath().getParent().getName() for status in found or []]
    return sorted(int(name.removeprefix("batch=")) for name in names)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(folder)


def snapshot(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The newest state that ``keep_snapshot`` has written, or the newest of a batch under ``before``; empty without any."""
    done = [number for number in _ended(spark, path) if before is None or number < before]
    reader = spark.read.schema(schema)
    return reader.parquet(f"{path}/batch={done[-1]}") if done else spark.createDataFrame([], schema)


def keep_snapshot(
    changes: DataFrame, path: str, control: StreamControl, key: str = KEY, order: Sequence[str] = ORDER
) -> StreamingQuery:
    """Keep the latest state of a stream of changes as Parquet below ``path``, one version per batch.

    Each batch is reduced to its last change per key and merged with the version before it.
    Older versions stay until their owner removes them; the last two are needed.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        state = snapshot(spark, path, batch.schema, before=number)
        merged = merge_latest(state, latest(batch, key, order), key, order)
        merged.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = control.configure(changes.writeStream.foreachBatch(merge))
    return writer.start()


def with_rejects(values: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """One row per record: ``keep``, the decoded fields, and ``rejected``, the text of a record that is no JSON object.

    Each record is parsed once, and both outcomes come from that parse.
    """
    return decode_changes(values, schema, value, keep, rejects=True)


def land_with_rejects(
    values: DataFrame,
    schema: T.StructType,
    path: str,
    control: StreamControl | None = None,
    value: str = "value",
    keep: Sequence[str] = (),
) -> StreamingQuery | None:
    """Records and rejects in one write: below each batch's folder ``outcome=kept`` and ``outcome=rejected``, as JSON.

    A rejected record has its text in ``rejected``, a kept one its fields. A batch frame is batch 0.
    """
    rows = with_rejects(values, schema, value, keep)
    rows = rows.withColumn("outcome", F.when(F.col("rejected").isNull(), KEPT).otherwise(REJECTED))

    def write(batch: DataFrame, number: int) -> None:
        writer = batch.write.mode("overwrite").partitionBy("outcome").option("ignoreNullFields", "false")
        writer.json(f"{path}/batch={number}")

    if not rows.isStreaming:
        write(rows, 0)
        return None
    if control is None:
        raise ValueError("a stream needs a StreamControl")
    return control.configure(rows.writeStream.foreachBatch(write)).start()


def landed(spark: SparkSession, path: str, schema: T.StructType, outcome: str) -> DataFrame:
    """What ``land_with_rejects`` has written with ``outcome``, of batches that have ended."""
    folders = [f"{path}/batch={number}/outcome={outcome}" for number in _ended(spark, path)]
    there = [folder for folder in folders if _exists(spark, folder)]  # a batch may have no record of one outcome
    return spark.read.schema(schema).json(there) if there else spark.createDataFrame([], schema)
