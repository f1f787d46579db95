"""Read again what a stream read in a range of its batches, by the positions its checkpoint has saved."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EARLIEST = -2
FILE_ENTRY = "path string, timestamp long, batchId long"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the batches that have an entry in a folder of the checkpoint."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    names = [status.getPath().getName() for status in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(int(name) for name in names if name.isdigit())


def batches(spark: SparkSession, checkpoint: str) -> list[int]:
    """The batches that have ended and whose position the checkpoint still has."""
    return sorted(set(_numbers(spark, f"{checkpoint}/commits")) & set(_numbers(spark, f"{checkpoint}/offsets")))


def position(spark: SparkSession, checkpoint: str, batch: int, source: int = 0) -> dict | None:
    """Where ``batch`` ended in a source: topic, partition and offset, or a number of a file source's log."""
    # After a line each for version and metadata, a line per source; the lines are a few and short.
    lines = spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True).first().value.split("\n")
    saved = json.loads(lines[2 + source]) if lines[2 + source] != "-" else None
    return saved if saved is None or isinstance(saved, dict) else {"logOffset": saved}


def span(spark: SparkSession, checkpoint: str, first: int, last: int, source: int = 0) -> tuple[dict | None, dict | None]:
    """The positions before ``first`` and after ``last``, both ended batches; None before the first of all."""
    known = set(batches(spark, checkpoint))
    if first > last or first < 0:
        raise ValueError(f"no range of batches: {first} to {last}")
    if missing := {last, *([first - 1] if first else [])} - known:
        raise ValueError(f"positions of batches {sorted(missing)} are not in {checkpoint}")
    return position(spark, checkpoint, first - 1, source) if first else None, position(spark, checkpoint, last, source)


def kafka_range(start: dict | None, end: dict) -> dict[str, str]:
    """Options of a batch read of a topic between two positions; partitions that ``start`` lacks are read from the earliest.

    Pass them as ``extra`` of a ``KafkaConfig`` and read with ``streaming=False``. Records that
    the broker no longer has fail the read (``failOnDataLoss``).
    """
    begun = {
        topic: {part: (start or {}).get(topic, {}).get(part, EARLIEST) for part in parts} for topic, parts in end.items()
    }
    return {"startingOffsets": json.dumps(begun), "endingOffsets": json.dumps(end), "failOnDataLoss": "true"}


def files_between(spark: SparkSession, checkpoint: str, start: dict | None, end: dict | None, source: int = 0) -> DataFrame:
    """(path) of the files a file source took between two positions; none when it had taken none by ``end``."""
    low, high = [-1 if at is None else at["logOffset"] for at in (start, end)]
    entries = spark.read.text(f"{checkpoint}/sources/{source}/*").where("value LIKE '{%'")
    parsed = entries.select(F.from_json("value", FILE_ENTRY).alias("e")).select("e.*")
    # The log repeats old entries where it is compacted.
    return parsed.where((F.col("batchId") > low) & (F.col("batchId") <= high)).select("path").distinct()


def replayed_files(spark: SparkSession, checkpoint: str, first: int, last: int, source: int = 0) -> list[str]:
    """The files that batches ``first`` to ``last`` read, to be read again as a batch; a path per file goes to the driver."""
    rows = files_between(spark, checkpoint, *span(spark, checkpoint, first, last, source), source)
    return sorted(row.path for row in rows.collect())
