"""Audit of how filters interact, with exact duplicates found by radix tries over whole texts.

1. A scan gives each row the mask of the filters A to D that it fails. In windows of
   bounded size it also drops copies: of equal texts one row with the smallest id goes on
   with its text, the others are duplicates already.
2. Texts are range-partitioned by prefixes of adaptive length: a prefix under which more
   than ``PREFIX_BYTES`` of text lie is doubled, until it is light or the whole text. Equal
   texts have equal prefixes, so they meet in one range.
3. Each range inserts its whole texts into a compressed trie, whose terminals hold the
   smallest id. A traversal flags the rows whose id is larger than their terminal's.
4. Masks are counted per part and label. Everything the report needs of any order of the
   filters, these counts determine.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS = 100
WINDOW_BYTES = 16 << 20
PREFIX_BYTES = 4 << 20
RANGE_BYTES = 16 << 20
LEAST_RANGES = 16
FIRST_PREFIX = 8  # bytes
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = b"#$%&*|"
_FOLLOWING = bytes(range(0x80, 0xC0))  # all bytes of a code point but its first


def failed(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()  # of bytes: at ASCII white space only
    points = len(text.translate(None, _FOLLOWING))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * capitals > 10 * points) << 2
        | (len(text.translate(None, _MARKS)) < len(text)) << 3
    )


def _order(key: object) -> tuple:
    """Ids in order, null last."""
    return (key is None, key if key is not None else 0)


class Trie:
    """A compressed trie of byte strings; each terminal holds the smallest id, and the rows that end there."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]  # label, children by first byte, terminal

    def insert(self, text: bytes, row: int, key: object) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                child = node[1][text[at]] = [text[at:] if at else text, {}, None]
                node, at = child, len(text)
                break
            label = child[0]
            if not text.startswith(label, at):
                shared = self._shared(label, text, at)
                below = [label[shared:], child[1], child[2]]
                child[0], child[1], child[2] = label[:shared], {label[shared]: below}, None
                label = child[0]
            node, at = child, at + len(label)
        if node[2] is None:
            node[2] = [_order(key), []]
        terminal = node[2]
        terminal[0] = min(terminal[0], _order(key))
        terminal[1].append((row, _order(key)))

    @staticmethod
    def _shared(label: bytes, text: bytes, at: int) -> int:
        """How many bytes of ``label`` begin ``text`` from ``at``, by halving."""
        low, high = 0, min(len(label), len(text) - at)
        while low < high:
            middle = (low + high + 1) // 2
            if text.startswith(label[low:middle], at + low):
                low = middle
            else:
                high = middle - 1
        return low

    def flags(self) -> Iterator[tuple[int, bool]]:
        """(row, whether a smaller id has the same text) of every row, depth first."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if node[2] is not None:
                least, rows = node[2]
                for row, key in rows:
                    yield row, key > least
            stack.extend(node[1].values())


def scan(batches: Iterable[pa.RecordBatch], window: int = WINDOW_BYTES) -> Iterator[pa.RecordBatch]:
    """(row, id, part, mask, face, text): the failed filters of each row, and texts without the window's copies.

    ``face`` is the row that stands for a row's text in the trie, null for a row that is a
    duplicate already. A text longer than the window is a window of its own.
    """
    held: list[tuple] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            for row, key, name, text in zip(*(part.column(c).to_pylist() for c in ("row", "id", "part", "text")), strict=True):
                text = text or b""
                held.append((row, key, name, failed(text), text))
                size += len(text) + 100
            if size > window:
                yield _window(held, batch.schema.field("id").type)
                held, size = [], 0
    if held:
        yield _window(held, batch.schema.field("id").type)


def _window(held: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    first: dict[bytes, tuple] = {}
    for row, key, _, _, text in held:
        known = first.get(text)
        if known is None or (_order(key), row) < known:
            first[text] = (_order(key), row)
    out = []
    for row, key, name, mask, text in held:
        least, face = first[text]
        same = _order(key) == least
        out.append((row, key, name, mask, face if same else None, text if face == row else None))
    kinds = [pa.int64(), kind, pa.string(), pa.int32(), pa.int64(), pa.binary()]
    names = ["row", "id", "part", "mask", "face", "text"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=names)


def with_prefixes(texts: DataFrame, prefix_bytes: int = PREFIX_BYTES, first: int = FIRST_PREFIX) -> DataFrame:
    """``texts`` (row, id, text) with ``prefix``: a beginning of the text under which at most ``prefix_bytes`` lie.

    A prefix that is heavy is tried at twice its length, and is the whole text at last; so
    only copies of one text can stay together beyond the bound, one from each window of the
    scan. A length has no more heavy prefixes than the bound fits into all texts.
    """
    size, length, still = F.lit(first), first, texts
    while True:
        begun = F.substring("text", 1, length)
        counted = still.groupBy(begun.alias("heavy")).agg(
            F.sum(F.octet_length("text")).alias("bytes"), F.max(F.octet_length("text")).alias("longest")
        )
        heavy = written(counted.where(f"bytes > {prefix_bytes} AND longest > {length}").select("heavy"), "trie-heavy")
        if heavy.isEmpty():
            return texts.withColumn("size", size).withColumn("prefix", F.expr("substring(text, 1, size)")).drop("size")
        texts = texts.join(heavy, begun == F.col("heavy"), "left").withColumn(f"over{length}", F.col("heavy").isNotNull()).drop("heavy")
        size = F.when(F.col(f"over{length}"), 2 * length).otherwise(size)
        still = still.join(heavy, begun == F.col("heavy"), "left_semi")
        length *= 2


def copies(
    texts: DataFrame, range_bytes: int = RANGE_BYTES, prefix_bytes: int = PREFIX_BYTES, least_ranges: int = LEAST_RANGES
) -> DataFrame:
    """(row, copy) for ``texts`` (row, id, text): whether the same text has a smaller id elsewhere in them."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(least_ranges, -(-total // range_bytes))

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie()
        for batch in batches:
            for row, key, text in zip(*(batch.column(c).to_pylist() for c in ("row", "id", "text")), strict=True):
                trie.insert(text, row, key)
        found: list[tuple] = []
        for flag in trie.flags():
            found.append(flag)
            if len(found) == 50_000:
                yield _flags(found)
                found = []
        if found:
            yield _flags(found)

    dealt = with_prefixes(texts, prefix_bytes).select("row", "id", "text", "prefix").repartitionByRange(ranges, "prefix")
    return dealt.select("row", "id", "text").mapInArrow(build, "row long, copy boolean")


def _flags(found: list[tuple]) -> pa.RecordBatch:
    rows, flags = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(flags, pa.bool_())], names=["row", "copy"])


def masks(docs: DataFrame, id_col: str, text_col: str, part_col: str, **settings) -> DataFrame:
    """(row, id, part, mask) of each row, with the bit of E where a smaller id has the same text."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    rows = written(
        rows.mapInArrow(scan, f"row long, id {kind}, part string, mask int, face long, text binary"), "audit-rows"
    )
    flags = copies(rows.where("text IS NOT NULL").select("row", "id", "text"), **settings)
    flags = written(flags.select(F.col("row").alias("face_row"), "copy"), "audit-flags")
    # A row without a face is a duplicate; its own number is nobody's face, and keeps such rows apart in the join.
    met = rows.drop("text").join(flags, F.coalesce("face", "row") == F.col("face_row"), "left")
    copy = F.col("face").isNull() | F.col("copy")
    return met.select("row", "id", "part", F.col("mask").bitwiseOR(F.when(copy, COPY).otherwise(0)).alias("mask"))


def _steps() -> str:
    """Every step of every order: the filter's bit, and the bits of those before it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append({"filter_order": "".join(order), "step": step, "bit": bit, "before": before})
            before |= bit
    return json.dumps(out)


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
    **settings,
) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A null text is an empty one, and equal to it. A null part is the part of the empty
    string. A null id is larger than all others: its row is a duplicate if any row with an
    id has its text. Rows that repeat an id do not make each other duplicates. A document
    labelled more than once is good, or toxic, if one of its labels is 1; null ids have no
    label. Other columns are not looked at. An empty table has no parts and gives no rows.
    """
    failing = written(masks(docs, id_col, text_col, part_col, **settings).select("id", "part", "mask"), "audit-masks")
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), "quality", "toxic")
        .where("id IS NOT NULL")
        .groupBy("id")
        .agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    )
    labelled = failing.where("id IS NOT NULL").join(known, "id", "left").select("part", "mask", "good", "toxic")
    no = F.lit(None).cast("boolean")
    labelled = labelled.unionByName(failing.where("id IS NULL").select("part", "mask", no.alias("good"), no.alias("toxic")))
    counts = labelled.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    entries = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 at most
    step = "array<struct<filter_order: string, step: int, bit: int, before: int>>"
    every = entries.select("part", "masks", F.inline(F.from_json(F.lit(_steps()), step)))

    def total(value: str, where: str) -> Column:
        return F.expr(f"aggregate(filter(masks, m -> {where}), 0L, (sum, m) -> sum + {value})")

    here = "m.mask & before = 0 AND m.mask & bit <> 0"
    return every.select(
        "part",
        "filter_order",
        "step",
        total("m.n", "m.mask & (before | bit) = 0").alias("kept"),
        total("m.n", here).alias("removed"),
        total("m.n", "m.mask & before <> 0 AND m.mask & bit <> 0").alias("redundant"),
        total("m.n", "m.mask = bit").alias("unique_fails"),
        total("m.good", here).alias("good_lost"),
        total("m.toxic", here).alias("toxic_lost"),
        # Of the filters that a row fails each comes first in as many orders.
        total(f"m.n * ({factorial(len(FILTERS))} div bit_count(m.mask))", "m.mask & bit <> 0").alias("shapley"),
    )


def audit_sql() -> str:
    """The same in DuckDB, every order applied to every document."""
    words = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    capitals = "length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g'))"
    bits = " + ".join(
        [
            "(len(w) < 100)::INT",
            "2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT",
            f"4 * (100 * {capitals} > 10 * length(coalesce(text, '')))::INT",
            "8 * regexp_matches(coalesce(text, ''), '[#$%&*|]')::INT",
            "16 * (doc_id IS DISTINCT FROM least AND least IS NOT NULL)::INT",
        ]
    )
    letters = ", ".join(f"('{x}', {1 << k})" for k, x in enumerate(FILTERS))
    joins = " ".join(
        f"JOIN f f{k} ON " + " AND ".join(f"f{k}.x <> f{i}.x" for i in range(k)) for k in range(1, len(FILTERS))
    )
    orders = " UNION ALL ".join(
        "SELECT "
        + " || ".join(f"f{k}.x" for k in range(len(FILTERS)))
        + f" AS filter_order, {step + 1} AS step, f{step}.b AS bit, "
        + " + ".join(["0", *(f"f{k}.b" for k in range(step))])
        + f" AS before FROM f f0 {joins}"
        for step in range(len(FILTERS))
    )
    here = "mask & before = 0 AND mask & bit <> 0"
    return (
        f"WITH f(x, b) AS (VALUES {letters}),"
        f" o AS ({orders}),"
        f" t AS (SELECT doc_id, lang, text, {words} AS w, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents),"
        f" d AS (SELECT doc_id, coalesce(lang, '') AS part, {bits} AS mask FROM t),"
        " k AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),"
        " m AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic"
        " FROM d LEFT JOIN k USING (doc_id) GROUP BY part, mask),"
        " r AS (SELECT part, filter_order, step, any_value(bit) AS bit,"
        " coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,"
        f" coalesce(sum(n) FILTER ({here}), 0)::BIGINT AS removed,"
        " coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,"
        " coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,"
        f" coalesce(sum(good) FILTER ({here}), 0)::BIGINT AS good_lost,"
        f" coalesce(sum(toxic) FILTER ({here}), 0)::BIGINT AS toxic_lost"
        " FROM m CROSS JOIN o GROUP BY part, filter_order, step)"
        " SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,"
        " (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"
    )
