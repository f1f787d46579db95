"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``radius`` bits share a variant that lies within half the
radius of both. Every distinct fingerprint emits all its variants, variants are
shuffled, and fingerprints that meet on one are linked. All that meet on a variant
are within ``radius`` of each other, so a star to the smallest of them loses
nothing and no bucket is ever expanded into pairs.

Variants are made and shuffled in ``PASSES`` slices of the variant space, the
shuffle files of one slice being dropped before the next: the disk in use is that
of one slice. A variant travels as itself and the number of the bit mask that made
it, ten bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, released_shuffles, text_rows, trimmed, written
from tidemark.streaming.workspace import workspace

SHINGLE = 4
SEED = 42
RADIUS = 4
PASSES = 8
VARIANTS_PER_GROUP = 1_500_000
LEAST_GROUPS = 64
CHUNK = 1024  # fingerprints of one shuffled block
SLICE = 64  # fingerprints whose variants are in memory at a time
PRINTS_PER_TASK = 1 << 13
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: bytes, size: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text; zero for a text without words."""
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [digest(b" ".join(words), seed)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        hashes = [
            digest(joined[i:j], seed)
            for i, j in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
        ]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row, fp as a signed long of the 64 bits."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_rows(batches):
            prints = np.array([fingerprint(x) for x in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(trimmed(run), f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def ball_masks(half: int) -> np.ndarray:
    """Every change of at most ``half`` of 64 bits."""
    return np.array(
        [sum(1 << i for i in bits) for n in range(half + 1) for bits in combinations(range(64), n)],
        dtype=np.uint64,
    )


def _forest(members: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
    """Links (member, root) that span what the buckets join; ``starts`` marks each bucket's first member."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    head = 0
    for value, first in zip(members.tolist(), starts.tolist(), strict=True):
        if first:
            head = find(value)
        elif (other := find(value)) != head:
            low, high = min(head, other), max(head, other)
            parent[high], head = low, low
    return [(x, find(x)) for x in parent]


def ball_links(prints: DataFrame, radius: int = RADIUS, passes: int = PASSES) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join all pairs within ``radius`` bits.

    Links of one bucket and of one group of buckets are reduced to a spanning forest.
    The radius must be even: only then are all fingerprints that meet within it.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    spark = prints.sparkSession
    masks = ball_masks(radius // 2)
    count = prints.count()
    groups = max(LEAST_GROUPS, -(-count * len(masks) // (VARIANTS_PER_GROUP * passes)))
    prints = prints.select("fp").repartition(-(-count // PRINTS_PER_TASK) or 1)
    path = workspace(spark, "ball-links")

    def emit(number: int):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                for at in range(0, len(fps), CHUNK):
                    picked = []
                    for low in range(at, min(at + CHUNK, len(fps)), SLICE):
                        variants = (fps[low : min(low + SLICE, at + CHUNK), None] ^ masks[None, :]).ravel()
                        where = (variants * _SPREAD) >> np.uint64(32)
                        mine = np.flatnonzero(where % np.uint64(passes) == number)
                        group = ((where[mine] // np.uint64(passes)) % np.uint64(groups)).astype(np.uint32)
                        picked.append((variants[mine], (mine % len(masks)).astype(np.uint16), group))
                    values, used, group = map(np.concatenate, zip(*picked, strict=True))
                    order = np.argsort(group, kind="stable")
                    values, used = values[order], used[order]
                    ends = np.cumsum(np.bincount(group, minlength=groups))
                    starts = np.concatenate(([0], ends[:-1]))
                    full = np.flatnonzero(ends > starts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(full.astype(np.int32)),
                            pa.array([values[starts[i] : ends[i]].tobytes() for i in full], pa.binary()),
                            pa.array([used[starts[i] : ends[i]].tobytes() for i in full], pa.binary()),
                        ],
                        names=["bucket", "variants", "masks"],
                    )

        return run

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        values = np.frombuffer(b"".join(rows["variants"]), np.uint64)
        used = np.frombuffer(b"".join(rows["masks"]), np.uint16)
        ordered = np.sort(values)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
        met = np.flatnonzero(shared[np.minimum(np.searchsorted(shared, values), len(shared) - 1)] == values)
        at, fps = values[met], values[met] ^ masks[used[met]]
        order = np.lexsort((fps, at))
        at, fps = at[order], fps[order]
        first = np.concatenate(([True], at[1:] != at[:-1]))
        heads = fps[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        near = np.bitwise_count(fps ^ heads) <= radius  # holds for all; stated, not assumed
        found = _forest(fps[near].view(np.int64), first[near])
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    with released_shuffles(spark):
        for number in range(passes):
            blobs = prints.mapInArrow(trimmed(emit(number)), "bucket int, variants binary, masks binary")
            links = blobs.repartition(groups, "bucket").groupBy("bucket").applyInPandas(meet, "a long, b long")
            links.write.mode("append").parquet(path)
    return spark.read.schema("a long, b long").parquet(path)


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(id, fingerprint, component_id) per row of ``docs``; components of links at ``radius`` bits or fewer.

    A null or empty text, or one of white space only, has fingerprint zero and is
    linked like any other. A null id keeps its row and never is a component's name
    unless all ids of the component are null. Repeated rows each give a row. Other
    columns are not looked at, whatever their names. An empty table gives no rows.
    """
    rows = written(fingerprints(docs, id_col, text_col), "simhash-rows")
    least = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(ball_links(least, radius), "simhash-components")
    member = written(
        least.join(roots, least["fp"] == roots["node"], "left").select(
            "fp", F.coalesce("root", "fp").alias("root"), "least"
        ),
        "simhash-members",
    )
    names = written(member.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-names")
    classes = written(member.join(names, "root").select("fp", "component_id"), "simhash-classes")
    return rows.join(classes, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` of each component: the one with the smallest id, null being the largest.

    Rows are told apart by number, so of rows that repeat an id, or have none, one stays like of any others.
    """
    fields = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # by position: columns may bear any name
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`").alias(k) for c, k in fields.items()]
    )
    rows = written(rows, "keep-rows")
    groups = simhash_components(rows, "row", fields[text_col], radius)
    named = rows.select("row", F.col(fields[id_col]).alias("id")).join(groups.select("row", "component_id"), "row")
    named = written(named, "keep-named")
    first = F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "row")).alias("first")
    kept = written(named.groupBy("component_id").agg(first).select("first.row"), "keep-one")
    dropped = written(named.select("row").join(kept, "row", "left_anti"), "keep-dropped")
    return rows.join(dropped, "row", "left_anti").select(*[F.col(k).alias(c) for c, k in fields.items()])
