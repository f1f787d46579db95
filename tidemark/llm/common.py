"""Helpers shared by the operators: written tables, fresh columns, connected components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.workspace import workspace

#: Where each table of ``written`` that is still in use lies.
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """From now on texts go to Python workers in batches of ``BATCH_BYTES`` at most; a smaller setting stays.

    By default a batch may have 64 MB, of which a task holds several copies at a time.
    """
    now = spark.conf.get(_BATCH).removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        spark.conf.set(_BATCH, f"{BATCH_BYTES}b")


@contextmanager
def released_shuffles(spark: SparkSession):
    """Shuffle files of each query run inside are dropped when that query ends."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder, so that lineage ends and executors may be lost."""
    spark = df.sparkSession
    path = workspace(spark, purpose)
    small_batches(spark)
    with released_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` of which all that was made is written itself."""
    for one in tables:
        spark = one.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop(one))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def trimmed(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """``run``, giving what its task held back to the system at the end: a worker process outlives the task."""

    def whole(batches: Iterable) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
        if trim is not None:
            trim(0)

    return whole


def text_rows(batches: Iterable[pa.RecordBatch], column: int = -1) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch with its text column as UTF-8 bytes, null as empty."""
    for batch in batches:
        yield batch, [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, purpose: str) -> DataFrame:
    """Connected components of undirected ``links`` (a, b), as (node, root) with the smallest node as root.

    Alternating large-star and small-star rounds: joins and minima only, so a node
    with very many links is a skewed join, which is split, and never one group.
    Nodes without a link to another node are not in the result.
    """
    edges = written(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        purpose,
    )
    before = _signature(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), purpose)
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), purpose)
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), purpose)
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(least.select("a", F.col("m").alias("b")).union(moved).distinct(), purpose)
        now = _signature(edges)
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
