"""Exact removal of long repeated byte strings with a logarithmic family of suffix arrays.

A byte goes if it is covered by a ``LENGTH``-byte string that also starts anywhere
else, in the same document or another; strings never cross documents.

1. Every window of ``LENGTH`` bytes is named by the smallest hash among the
   ``ANCHOR``-byte strings inside it, its anchor. Equal windows have equal anchors, so
   an anchor met once proves a whole run of windows unique. Of each maximal run of
   windows with one anchor (a block, about a hundred windows) only the anchor and a
   hash of the block's bytes are shuffled.
2. A block whose bytes occur twice is repeated as a whole. Windows are looked at one by
   one only in blocks that share their anchor with a different block, and of equal
   blocks in one.
3. Those suffixes are indexed in buckets of anchors: each new batch of blocks gets a
   suffix array, which is merge-scanned against the existing levels for equal
   ``LENGTH``-byte prefixes; then levels of about equal size merge, so that a suffix is
   merged a logarithmic number of times. Suffixes are ordered by their first eight bytes,
   then by a 64-bit fingerprint of the first ``LENGTH``: all that is asked of the order is
   that equal prefixes are neighbours.

An anchor with more than ``HEAVY`` different blocks (a passage a little shorter than
``LENGTH`` in very many documents), or with more windows than a bucket should have (one
line repeated for long), is not left to one bucket: its windows are shuffled one by one by
fingerprint. Neither way loses a repeat; that strings of one fingerprint are equal is
taken for granted, not verified.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, trimmed, written

LENGTH = 400
ANCHOR = 200
HEAVY = 4096
SEGMENT = 1 << 20
SLICE = 1 << 16
BATCH_WINDOWS = 1 << 17
BUCKET_WINDOWS = 1 << 20
LEAST_BUCKETS = 64

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_JOIN = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(32))


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every window of ``length`` bytes, by doubling: log2(length) passes."""
    if len(data) < length:
        return np.empty(0, np.uint64)
    level, size, parts = _mixed(data.astype(np.uint64) + np.uint64(1)), 1, []
    while True:
        if length & size:
            parts.append((size, level))
        if size * 2 > length:
            break
        level = level[:-size] * (_STEP + np.uint64(2 * size)) + level[size:]
        level ^= level >> np.uint64(29)
        size *= 2
    out, at, count = np.zeros(len(data) - length + 1, np.uint64), 0, len(data) - length + 1
    for size, level in reversed(parts):
        out = out * _JOIN + level[at : at + count]
        at += size
    return _mixed(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    blocks = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    left = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    right = np.minimum.accumulate(blocks, axis=1).ravel()
    count = len(values) - width + 1
    return np.minimum(left[:count], right[width - 1 : width - 1 + count])


def blocks_of(text: bytes, length: int, anchor: int) -> Iterator[tuple[int, int, int, int, bool]]:
    """(anchor, hash, first window, windows, whether its anchor occurs in it twice) of each block.

    Long texts are read in segments; a block cut by their bounds is two blocks.
    """
    width = length - anchor + 1
    for base in range(0, len(text) - length + 1, SEGMENT):
        part = text[base : base + SEGMENT + length - 1]
        grams = window_hashes(np.frombuffer(part, np.uint8), anchor)
        least = sliding_min(grams, width)
        starts = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
        ends = np.append(starts[1:], len(least))
        names = least[starts]
        for name, key, i, j in zip(
            names, names.view(np.int64).tolist(), starts.tolist(), ends.tolist(), strict=True
        ):
            twice = j - i > width or int(np.count_nonzero(grams[i : j - 1 + width] == name)) > 1
            block = xxhash.xxh3_64_intdigest(part[i : j - 1 + length])
            yield key, block - (1 << 64) if block >> 63 else block, base + i, j - i, twice


class SuffixLevels:
    """Sorted arrays of distinct suffix keys, each at least twice as long as the next.

    ``add`` takes a batch of suffixes, as keys and numbers, and returns the numbers of
    all suffixes now known to have an equal: those of the batch, and earlier ones that
    had none before.
    """

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        order = np.argsort(keys, kind="stable")
        keys, numbers = keys[order], numbers[order]
        same = keys[1:] == keys[:-1]
        paired = np.concatenate((same, [False])) | np.concatenate(([False], same))
        found = [numbers[paired]]
        first = np.concatenate(([True], ~same))
        keys, numbers, paired = keys[first], numbers[first], paired[first]
        new = np.ones(len(keys), bool)
        for level_keys, level_numbers, level_paired in self.levels:
            at = np.minimum(np.searchsorted(level_keys, keys), len(level_keys) - 1)
            hit = level_keys[at] == keys
            found.append(numbers[hit & ~paired])
            paired |= hit
            new &= ~hit
            met = at[hit]
            found.append(level_numbers[met[~level_paired[met]]])
            level_paired[met] = True
        if new.any():  # a key that a level has already stays there
            self.levels.append((keys[new], numbers[new], paired[new]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            self._merge()
        return np.concatenate(found)

    def _merge(self) -> None:
        low, high = self.levels.pop(), self.levels.pop()
        keys = np.concatenate((high[0], low[0]))
        order = np.argsort(keys, kind="stable")
        self.levels.append((keys[order], *(np.concatenate((x, y))[order] for x, y in zip(high[1:], low[1:], strict=True))))


def suffix_keys(block: bytes, length: int) -> np.ndarray:
    """Key of each suffix with ``length`` bytes left: its first eight bytes, then the fingerprint."""
    data = np.frombuffer(block, np.uint8)
    count = len(data) - length + 1
    keys = np.empty((count, 16), np.uint8)
    for i in range(8):
        keys[:, i] = data[i : i + count]
    keys[:, 8:] = window_hashes(data, length).astype(">u8").view(np.uint8).reshape(-1, 8)
    return keys.view("S16").ravel()


def _runs(rows: np.ndarray, starts: np.ndarray, length: int) -> pd.DataFrame:
    """Spans (row, start, end) covered by windows at ``starts``."""
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    cut = (rows[1:] != rows[:-1]) | (starts[1:] > starts[:-1] + length)
    first, last = np.ones(len(rows), bool), np.ones(len(rows), bool)
    first[1:], last[:-1] = cut, cut
    return pd.DataFrame({"row": rows[first], "start": starts[first], "end": starts[last] + length})


def index_bucket(blocks: pd.DataFrame, length: int, batch_windows: int = BATCH_WINDOWS) -> pd.DataFrame:
    """Spans of the open blocks of one bucket that are covered by repeated windows."""
    sizes = blocks["data"].map(len).to_numpy() - length + 1
    index, found = SuffixLevels(), []
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    at = 0
    while at < len(blocks):
        stop = max(at + 1, int(np.searchsorted(bounds, bounds[at] + batch_windows, side="right")) - 1)
        keys = np.concatenate([suffix_keys(x, length) for x in blocks["data"].iloc[at:stop]])
        found.append(index.add(keys, np.arange(bounds[at], bounds[stop])))
        at = stop
    numbers = np.concatenate(found)
    block = np.searchsorted(bounds, numbers, side="right") - 1
    still = ~blocks["whole"].to_numpy()[block]
    numbers, block = numbers[still], block[still]
    starts = blocks["start"].to_numpy()[block] + numbers - bounds[block]
    return _runs(blocks["row"].to_numpy()[block], starts, length)


def repeated_spans(
    rows: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, heavy: int = HEAVY, heavy_windows: int = BUCKET_WINDOWS
) -> DataFrame:
    """(row, found): the spans (start, end) of ``rows`` (row long, text string) covered by repeated strings; they may overlap.

    Tables made on the way are deleted when the spans are written.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "anchor", "block", "start", "windows", "twice"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            out: list[tuple] = []
            for row, text in zip(ids, texts, strict=True):
                out += [(row, *x) for x in blocks_of(text.as_py() or b"", length, anchor)]
                if len(out) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    block_schema = "row long, anchor long, block long, start long, windows long, twice boolean"
    met = written(rows.select("row", "text").mapInArrow(trimmed(scan), block_schema), "repeat-blocks")
    shared = (
        met.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("block").alias("low"), F.max("block").alias("high"), F.max("twice").alias("twice"))
        .where("n > 1 OR twice")
        .select("anchor", F.expr("low <> high OR twice").alias("open"))
    )
    blocks, shared = met, written(shared, "repeat-anchors")
    met = written(blocks.drop("twice").join(shared, "anchor"), "repeat-candidates")
    discard(blocks, shared)
    kinds = written(
        met.groupBy("anchor", "block", "open").agg(
            F.count("*").alias("copies"), F.min("row").alias("keeper"), F.max("windows").alias("each")
        ),
        "repeat-kinds",
    )
    whole = met.join(kinds.where("copies > 1").select("anchor", "block"), ["anchor", "block"]).select(
        "row", "start", F.expr(f"start + windows - 1 + {length}").alias("end")
    )

    opened = kinds.where("open")
    weight = opened.groupBy("anchor").agg((F.count("*") > heavy).alias("many"), F.sum("each").alias("each"))
    weight = written(weight.select("anchor", (F.col("many") | (F.col("each") > heavy_windows)).alias("heavy")), "repeat-weights")
    opened = written(opened.drop("each").join(weight, "anchor"), "repeat-open")
    chosen = (
        met.join(opened.drop("open"), ["anchor", "block"])
        .where("row = keeper")
        .groupBy("anchor", "block", "row", "windows", "copies", "heavy")
        .agg(F.min("start").alias("start"))
    )
    chosen = written(chosen, "repeat-chosen")
    total = chosen.agg(F.sum("windows")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_WINDOWS))
    data = written(
        chosen.join(rows.select("row", F.col("text").cast("binary").alias("text")), "row").select(
            "row",
            "start",
            "anchor",
            F.expr("copies > 1").alias("whole"),
            "heavy",
            F.expr(f"substring(text, cast(start + 1 AS int), cast(windows - 1 + {length} AS int))").alias("data"),
        ),
        "repeat-data",
    )
    spans = "row long, start long, end long"
    light = (
        data.where("NOT heavy")
        .withColumn("bucket", F.expr(f"pmod(xxhash64(anchor), {buckets})"))
        .select("bucket", "row", "start", "whole", "data")
        .groupBy("bucket")
        .applyInPandas(lambda pdf: index_bucket(pdf, length), spans)
    )

    def windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, start, whole_, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for at in range(0, len(block) - length + 1, SLICE):
                    keys = suffix_keys(block[at : at + SLICE + length - 1], length)
                    n = len(keys)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys.view("V16").tolist(), pa.binary()),
                            pa.array(np.full(n, row)),
                            pa.array(np.arange(start + at, start + at + n)),
                            pa.array(np.full(n, whole_)),
                        ],
                        names=["key", "row", "start", "whole"],
                    )

    single = written(
        data.where("heavy").select("row", "start", "whole", "data").mapInArrow(
            windows, "key binary, row long, start long, whole boolean"
        ),
        "repeat-windows",
    )
    again = written(single.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "repeat-keys")
    hot = single.where("NOT whole").join(again, "key").select(
        "row", "start", F.expr(f"start + {length}").alias("end")
    )
    found = F.collect_set(F.struct("start", "end")).alias("found")
    spans_of_row = written(whole.union(light).union(hot).groupBy("row").agg(found), "repeat-spans")
    discard(met, kinds, weight, opened, chosen, data, single, again)
    return spans_of_row


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut_repeats(
    docs: DataFrame,
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    heavy: int = HEAVY,
    heavy_windows: int = BUCKET_WINDOWS,
    short: int | None = None,
) -> DataFrame:
    """Each row of ``docs`` as a struct ``doc`` with n_bytes, n_removed, spans and the bytes ``kept``.

    With ``short``, a column ``n_short`` also counts the bytes that repeats of ``short``
    bytes would cover (anchor half of it); nothing is removed for it.

    ``spans`` are the maximal removed runs, as byte offsets in the text's UTF-8. A null
    text counts as empty. Texts shorter than ``length`` lose nothing. Repeated rows are
    repeated strings, so both lose them. Ids are not looked at, and other columns are
    carried inside ``doc``, whatever their names. An empty table gives no rows.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(text_col).alias("text"),
            F.struct(*others or [F.lit(True).alias("present")]).alias("doc"),
        ),
        "repeat-rows",
    )
    per_row = repeated_spans(rows, length, anchor, heavy, heavy_windows)
    if short is not None:
        shorter = repeated_spans(rows, short, short // 2, heavy, heavy_windows).withColumnRenamed("found", "near")
        per_row = per_row.join(shorter, "row", "full")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            near = batch.column("near").to_pylist() if short is not None else []
            for text, found in zip(batch.column("text").cast(pa.binary()), batch.column("found").to_pylist(), strict=True):
                text = text.as_py() or b""
                runs = _merged([(x["start"], x["end"]) for x in found or []])
                kept, at = [], 0
                for start, end in runs:
                    kept.append(text[at:start])
                    at = end
                kept.append(text[at:])
                out.append((len(text), sum(e - s for s, e in runs), runs, b"".join(kept)))
            size, removed, runs, kept = zip(*out) if out else ([], [], [], [])
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            columns = [
                batch.column("doc"),
                pa.array(size, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in x] for x in runs], pa.list_(span)),
                pa.array(kept, pa.binary()),
            ]
            names = ["doc", "n_bytes", "n_removed", "spans", "kept"]
            if short is not None:
                covered = [sum(e - s for s, e in _merged([(x["start"], x["end"]) for x in f or []])) for f in near]
                columns.append(pa.array(covered, pa.int64()))
                names.append("n_short")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        f"doc {rows.schema['doc'].dataType.simpleString()}, n_bytes long, n_removed long,"
        " spans array<struct<start: long, end: long>>, kept binary"
    )
    carried = ["doc", "text", "found"]
    if short is not None:
        schema += ", n_short long"
        carried.append("near")
    return rows.join(per_row, "row", "left").select(*carried).mapInArrow(trimmed(cut), schema)


def without_repeats(docs: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with ``text_col`` less its repeated strings.

    A character of which only a part was removed is removed as a whole. A null text stays null.
    """

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else x.decode("utf-8", "ignore") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["rest", "kept"])

    others = [c for c in docs.columns if c != text_col]
    fields = {c: f"c{i}" for i, c in enumerate(others)}  # by position: columns may bear any name
    marked = docs.select(
        F.col(f"`{text_col}`").alias("text"),
        F.struct(
            F.col(f"`{text_col}`").isNull().alias("absent"), *[F.col(f"`{c}`").alias(fields[c]) for c in others]
        ).alias("rest"),
    )
    cut = cut_repeats(marked, "text", **settings).select("doc.rest", "kept")
    decoded = cut.mapInArrow(decode, f"rest {cut.schema['rest'].dataType.simpleString()}, kept string")
    return decoded.select(
        *[
            F.when(~F.col("rest.absent"), F.col("kept")).alias(c)
            if c == text_col
            else F.col(f"rest.{fields[c]}").alias(c)
            for c in docs.columns
        ]
    )


def digest(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, and n_short if asked) of what ``cut_repeats`` returns."""
    return cut.select(
        F.col("doc").getField(id_col).alias(id_col),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        *(["n_short"] if "n_short" in cut.columns else []),
    )
