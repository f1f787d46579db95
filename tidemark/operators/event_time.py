"""Operators over event time with bounded state: repeats within a horizon, windows, joins by interval.

All take a batch or a stream; a batch has no watermark and gives every result. In a stream
the watermark is the latest event time seen less ``delay``. State older than it goes, windows
that end before it are final and come out once, and a row behind it is late: Spark leaves it
out and counts it (``late_rows``). Rows without an event time are in no window and no join;
``untimed`` gives them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.sql import sql_name

START = "window_start"
END = "window_end"


def untimed(rows: DataFrame, at: str) -> DataFrame:
    """The rows that have no event time."""
    return rows.where(rows[sql_name(at)].isNull())


def _timed(rows: DataFrame, at: str, delay: str) -> DataFrame:
    return rows.where(rows[sql_name(at)].isNotNull()).withWatermark(at, delay)


def first_within(rows: DataFrame, keys: Sequence[str], at: str, horizon: str) -> DataFrame:
    """Rows whose ``keys`` were not seen within ``horizon`` before; NULL is a key like others.

    A stream forgets a key when the watermark, the latest event time less ``horizon``, has
    passed its row's event time plus ``horizon``, so the state holds the keys of about two
    horizons. Of rows with one key in one batch any one stays. A batch is one horizon: each
    key is there once.
    """
    timed = _timed(rows, at, horizon)
    return timed.dropDuplicatesWithinWatermark(list(keys)) if rows.isStreaming else timed.dropDuplicates(list(keys))


def _grouped(rows: DataFrame, window: Column, keys: Sequence[str], totals: Sequence[Column]) -> DataFrame:
    found = rows.groupBy(window.alias("window"), *[sql_name(key) for key in keys]).agg(F.count("*").alias("n"), *totals)
    rest = [sql_name(name) for name in found.columns if name != "window"]
    return found.select(F.col("window.start").alias(START), F.col("window.end").alias(END), *rest)


def tumbling(
    rows: DataFrame, at: str, size: str, delay: str, keys: Sequence[str] = (), totals: Sequence[Column] = ()
) -> DataFrame:
    """(window_start, window_end, ``keys``, n, ``totals``) of windows that follow each other, end exclusive.

    Tasks reduce their rows to one per window and key before the shuffle, so no key is hot.
    """
    return _grouped(_timed(rows, at, delay), F.window(at, size), keys, totals)


def sliding(
    rows: DataFrame, at: str, size: str, slide: str, delay: str, keys: Sequence[str] = (), totals: Sequence[Column] = ()
) -> DataFrame:
    """As ``tumbling``, with a window of ``size`` begun every ``slide``; a row is in size / slide of them."""
    return _grouped(_timed(rows, at, delay), F.window(at, size, slide), keys, totals)


def sessions(
    rows: DataFrame, at: str, gap: str, delay: str, keys: Sequence[str] = (), totals: Sequence[Column] = ()
) -> DataFrame:
    """As ``tumbling``, with windows that last while rows of one key follow within ``gap``; they end ``gap`` after the last.

    A session is one group, so a key without pauses has one long session; only its totals are state.
    """
    return _grouped(_timed(rows, at, delay), F.session_window(at, gap), keys, totals)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    left_at: str,
    right_at: str,
    before: str,
    after: str,
    delay: str,
) -> DataFrame:
    """Pairs with equal ``keys`` whose right event time is at most ``before`` earlier and ``after`` later than the left's.

    A stream keeps each side's rows until the watermark says that no partner can come any
    more. The sides' column names must differ. A NULL key has no partner.
    """
    if both := set(left.columns) & set(right.columns):
        raise ValueError(f"columns on both sides: {', '.join(sorted(both))}")
    condition = F.expr(
        f"{sql_name(right_at)} >= {sql_name(left_at)} - interval {before}"
        f" AND {sql_name(right_at)} <= {sql_name(left_at)} + interval {after}"
    )
    for one, other in keys:
        condition &= F.col(sql_name(one)) == F.col(sql_name(other))
    return _timed(left, left_at, delay).join(_timed(right, right_at, delay), condition)


def _states(query: StreamingQuery) -> list[list]:
    return [progress.stateOperators for progress in query.recentProgress]


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were left out, in the progress that the session keeps of ``query``.

    It keeps ``spark.sql.streaming.numRecentProgressUpdates`` batches. Windows reduce a
    batch first: late rows of one batch, window and key that a task reduced count once.
    """
    return sum(state.numRowsDroppedByWatermark for batch in _states(query) for state in batch)


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows of state that ``query`` held after each batch that the session keeps progress of."""
    return [sum(state.numRowsTotal for state in batch) for batch in _states(query) if batch]
