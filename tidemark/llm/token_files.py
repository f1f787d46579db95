"""Token ids in flat binary files, with 64-bit document offsets, read through memory maps.

Files of one range of document ids each, in ascending order of the ids:

* ``<name>.ids``: the ids of its documents, one after the other, as little-endian unsigned
  integers of ``width`` bytes, no header;
* ``<name>.offsets``: for each document its id and a null mark, then n + 1 ends, as
  little-endian 64-bit integers: offsets of ids within the file.

Which files belong to the corpus, and how many documents and ids each has, is a table
written by Spark: files of attempts that failed are in no list. The base of a file is the
prefix sum of the counts before it: one row per file goes to the driver, no data.
"""

from __future__ import annotations

import mmap
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import released_shuffles, small_batches
from tidemark.llm.shared_files import fresh, located
from tidemark.llm.tokens import encoder
from tidemark.streaming.workspace import workspace

END = 0
WIDTH = 2
FLUSH = 1 << 22
FILE_LIST = "file string, first long, docs long, ids long"


@dataclass(frozen=True)
class TokenFiles:
    """A corpus of token files: their list, in order, with the base of each."""

    files: list[tuple[str, int, int, int]]
    width: int

    @property
    def total(self) -> int:
        return self.files[-1][3] + self.files[-1][2] if self.files else 0


def write_tokens(
    docs: DataFrame,
    tokenizer: str | Callable[[], str],
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end: int = END,
    width: int = WIDTH,
    parts: int | None = None,
) -> TokenFiles:
    """Encode whole texts and write them in ascending order of the id, nulls first.

    Rows that repeat an id stand in order of their texts. A null text counts as empty and
    has only the end id. Other columns are not looked at. An id beyond ``width`` bytes is an
    error. An empty table gives no files.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer if isinstance(tokenizer, str) else tokenizer(), end)
        name = fresh(folder, "")
        fs, path = located(name)
        keys: list[np.ndarray] = []
        nulls: list[np.ndarray] = []
        sizes: list[int] = []
        with fs.open_output_stream(f"{path}.ids") as out:
            for batch in batches:
                column = batch.column(0)
                keys.append(np.asarray(column.fill_null(0).to_numpy(zero_copy_only=False), "<i8"))
                nulls.append(np.asarray(column.is_null().to_numpy(zero_copy_only=False), "<i8"))
                for ids in tokens.encode_all(batch.column(1).to_pylist()):
                    wide = np.frombuffer(ids, "<u4")
                    if wide.max() >= 1 << (8 * width):
                        raise ValueError(f"token id {wide.max()} needs more than {width} bytes")
                    out.write(wide.astype(kind).tobytes())
                    sizes.append(len(wide))
        if not sizes:
            fs.delete_file(f"{path}.ids")
            return
        with fs.open_output_stream(f"{path}.offsets") as out:
            ends = np.concatenate(([0], np.cumsum(sizes))).astype("<i8")
            for part in (np.concatenate(keys), np.concatenate(nulls), ends):
                out.write(part.astype("<i8").tobytes())
        first = int(keys[0][0]) if not nulls[0][0] else None
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([first], pa.int64()), pa.array([len(sizes)]), pa.array([int(ends[-1])])],
            names=["file", "first", "docs", "ids"],
        )

    fs, place = located(folder)
    fs.create_dir(place, recursive=True)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    dealt = rows.repartitionByRange(*([parts] if parts else []), "id", F.xxhash64("text")).sortWithinPartitions("id", "text")
    with released_shuffles(spark):
        dealt.withColumn("part", F.spark_partition_id()).select("id", "text", "part").mapInArrow(
            _numbered(run), f"part int, {FILE_LIST}"
        ).write.parquet(f"{folder}/list")
    listed = spark.read.schema(f"part int, {FILE_LIST}").parquet(f"{folder}/list").orderBy("part").collect()
    files, base = [], 0
    for row in listed:
        files.append((row.file, row.docs, row.ids, base))
        base += row.ids
    return TokenFiles(files, width)


def _numbered(run: Callable) -> Callable:
    """The rows of ``run`` with the number of the partition they come from."""

    def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: list[int] = []

        def seen() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not part and batch.num_rows:
                    part.append(batch.column(2)[0].as_py())
                if batch.num_rows:
                    yield batch

        for out in run(seen()):
            number = pa.array([part[0]] * out.num_rows, pa.int32())
            yield pa.RecordBatch.from_arrays([number, *out.columns], names=["part", *out.schema.names])

    return numbered


def _mapped(fs: pafs.FileSystem, path: str):
    """The bytes of a file: mapped into memory where the file system is local, else read."""
    if isinstance(fs, pafs.LocalFileSystem):
        with open(path, "rb") as file:
            return mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
    with fs.open_input_file(path) as file:
        return file.read()


def documents_in(file: str, width: int, base: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, start in the corpus, ids) of each document of a file; the ids are a view into the map."""
    fs, path = located(file)
    table = np.frombuffer(_mapped(fs, f"{path}.offsets"), "<i8")
    count = (len(table) - 1) // 3
    ids = np.frombuffer(_mapped(fs, f"{path}.ids"), f"<u{width}")
    keys, nulls, ends = table[:count].tolist(), table[count : 2 * count].tolist(), table[2 * count :].tolist()
    for key, null, start, stop in zip(keys, nulls, ends, ends[1:], strict=False):
        yield (None if null else key), base + start, ids[start:stop]


def read_tokens(spark: SparkSession, corpus: TokenFiles) -> DataFrame:
    """(id, start, ids) of every document, ``ids`` as little-endian unsigned 32-bit integers; one task per file."""
    width = corpus.width

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows, size = [], 0
                for key, start, ids in documents_in(file, width, base):
                    rows.append((key, start, ids.astype("<u4").tobytes()))
                    size += len(ids)
                    if size > FLUSH:
                        yield _batch(rows)
                        rows, size = [], 0
                if rows:
                    yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        keys, starts, ids = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())],
            names=["id", "start", "ids"],
        )

    listed = spark.createDataFrame([(f, b) for f, _, _, b in corpus.files], "file string, base long")
    return listed.repartition(max(1, len(corpus.files))).mapInArrow(run, "id long, start long, ids binary")


def token_digest(docs: DataFrame, tokenizer: str | Callable[[], str], id_col: str = "doc_id") -> DataFrame:
    """Write ``docs``, read them back: (id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    corpus = write_tokens(docs, tokenizer, workspace(spark, "token-files"), id_col)
    return read_tokens(spark, corpus).select(
        F.col("id").alias(id_col),
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
