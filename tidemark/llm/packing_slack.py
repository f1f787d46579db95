"""Pack documents into sequences by minimum bin slack.

Documents longer than a sequence are cut into full sequences and a rest. Rests are packed
in groups of ``GROUP`` or so, dealt by hash, each by one task. A window is opened with the
longest rest; then subset-sum dynamic programming over bitsets tells which sums the other
rests can reach, the one nearest to the capacity is taken, and the counts of each length
are read back from the bitsets. The rests left over when nothing fills a window to
``FULL`` any more are gathered and packed again, all groups' together, until they fill no
further: so slack does not grow with the number of groups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written
from tidemark.llm.tokens import KNOWN, encoder

CAPACITY = 4096
GROUP = 4096
END = 2
#: Rows encoded at a time, and ids given on at a time: a task holds so much beside its batch.
ROWS = 256
IDS = 1 << 18


def fill(stock: Counter[int], capacity: int) -> Counter[int]:
    """The multiset of lengths in ``stock`` whose sum is nearest to ``capacity`` from below.

    Bit s of a mask says that s can be reached. One mask is kept per length used, and the
    counts are read back from the last to the first.
    """
    limit = (1 << (capacity + 1)) - 1
    lengths, masks = [], [1]
    for length in sorted(stock, reverse=True):
        if length > capacity:
            continue
        mask, left, step = masks[-1], min(stock[length], capacity // length), 1
        while left:  # copies in powers of two
            take = min(step, left)
            mask |= (mask << (take * length)) & limit
            left, step = left - take, step * 2
        lengths.append(length)
        masks.append(mask)
        if mask >> capacity & 1:
            break
    total, chosen = masks[-1].bit_length() - 1, Counter()
    for length, before in zip(reversed(lengths), reversed(masks[:-1]), strict=True):
        while not before >> total & 1:
            total -= length
            chosen[length] += 1
    return chosen


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indices into ``lengths``, each of at most ``capacity``."""
    of: dict[int, list[int]] = {}
    for i, length in enumerate(lengths):
        of.setdefault(length, []).append(i)
    stock, bins = Counter({k: len(v) for k, v in of.items()}), []
    while stock:
        longest = max(stock)
        taken = Counter({longest: 1})
        stock -= taken
        taken += fill(stock, capacity - longest)
        stock -= Counter(taken) - Counter({longest: 1})
        bins.append([of[length].pop() for length, n in sorted(taken.items(), reverse=True) for _ in range(n)])
    return bins


def tokenized(
    docs: DataFrame,
    tokenizer: str | Callable[[], str],
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    known: int = KNOWN,
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: (piece, id, start, length, doc_tokens, ids), written to the shared folder.

    ``ids`` are little-endian unsigned 32-bit integers, ``piece`` a number of its own. A null text counts as empty.
    ``known`` bounds the units that an encoder remembers; fewer take less memory and more time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(tokenizer if isinstance(tokenizer, str) else tokenizer(), end, known)
        names = ["id", "start", "length", "doc_tokens", "ids"]
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            out: list[tuple] = []
            size = 0
            for key, ids in zip(batch.column(0).to_pylist(), tokens.encode_all(batch.column(1).to_pylist()), strict=True):
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    out.append((key, start, len(part) // 4, total, part))
                size += total
                if size > IDS:
                    yield _batch(out, batch.schema.field(0).type, names)
                    out, size = [], 0
            if out:
                yield _batch(out, batch.schema.field(0).type, names)

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    pieces = rows.mapInArrow(
        run,
        f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, doc_tokens long, ids binary",
    )
    return written(pieces.select(F.monotonically_increasing_id().alias("piece"), "*"), "packing-pieces")


def _batch(rows: list[tuple], key: pa.DataType, names: list[str]) -> pa.RecordBatch:
    kinds = [key, pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def places(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """(piece, sequence_id, offset) of every row of ``pieces`` (piece, length)."""
    lengths = pieces.select("piece", "length")
    whole = lengths.where(F.col("length") == capacity).select(
        "piece", (F.col("piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    def run(keep_last: bool):
        def bins(rows: pd.DataFrame) -> pd.DataFrame:
            ids, sizes, out = rows["piece"].to_numpy(), rows["length"].to_numpy(), []
            for members in pack(sizes.tolist(), capacity):
                total = int(sizes[members].sum())
                slack = total < capacity and not keep_last
                ends = np.cumsum(sizes[members])
                for i, stop in zip(members, ends.tolist(), strict=True):
                    # An open bin is given up: its pieces are packed again with those of other groups.
                    out.append((ids[i], None if slack else int(ids[members[0]]) * 2, stop - sizes[i], sizes[i]))
            frame = pd.DataFrame(out, columns=["piece", "sequence_id", "offset", "length"])
            frame["sequence_id"] = frame["sequence_id"].astype("Int64")
            return frame

        return bins

    schema = "piece long, sequence_id long, offset long, length long"
    rest, done = lengths.where(F.col("length") < capacity), whole
    count = before = rest.count()
    again = False
    while count:
        groups = -(-count // group)
        # A round after one that placed no more than half of the rest, or none, is the last: it keeps open windows.
        last = groups == 1 or again and count > before // 2
        again = True
        packed = written(
            rest.withColumn("group", F.expr(f"pmod(xxhash64(piece, {count}), {groups})"))
            .groupBy("group")
            .applyInPandas(run(last), schema),
            "packing-places",
        )
        done = done.union(packed.where("sequence_id IS NOT NULL").select("piece", "sequence_id", "offset"))
        if last:
            break
        rest = packed.where("sequence_id IS NULL").select("piece", "length")
        before, count = count, rest.count()
    return done


def packed(
    docs: DataFrame,
    tokenizer: str | Callable[[], str],
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    group: int = GROUP,
) -> DataFrame:
    """(id, start, length, doc_tokens, ids, sequence_id, offset) per piece; each id of each document is in one.

    A null or empty text is a document of the end id alone. Rows that repeat an id are
    documents of their own. Other columns are not looked at. An empty table gives no rows.
    """
    pieces = tokenized(docs, tokenizer, id_col, text_col, capacity, end)
    return pieces.join(places(pieces, capacity, group), "piece").select(
        F.col("id").alias(id_col), "start", "length", "doc_tokens", "ids", "sequence_id", "offset"
    )


def packing_digest(docs: DataFrame, tokenizer: str | Callable[[], str], id_col: str = "doc_id", **settings) -> DataFrame:
    """As ``packed``, with a checksum in place of the ids."""
    pieces = tokenized(docs, tokenizer, id_col, **settings)
    sums = pieces.select(
        "piece", F.col("id").alias(id_col), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return sums.join(places(pieces), "piece").drop("piece")
