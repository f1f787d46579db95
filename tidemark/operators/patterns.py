"""Sequences of events per key, and values unlike those before, on whole tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.sql import sql_name

MICROSECOND = timedelta(microseconds=1)
#: Time slices of a key, in multiples of the longest match.
SLICES = 4


def _micros(span: timedelta) -> int:
    if span <= timedelta(0):
        raise ValueError("a span of time must be positive")
    return span // MICROSECOND


def sequences(
    rows: DataFrame,
    key: str,
    at: str,
    order: str,
    steps: Sequence[str],
    within: timedelta,
    strict: bool = False,
    slices: int = SLICES,
) -> DataFrame:
    """(key, ``step_1``, ``step_2``, …): for each row that begins a match, the ``order`` values of its steps.

    ``steps`` are SQL conditions on ``rows``. From a row that meets the first, the next row of
    the same key that meets the second is taken, and so on; ``strict`` wants each step in the
    very next row. Rows go by ``at``, then by ``order``, which tells rows of one key apart.
    A match whose last row is ``within`` of its first, that instant included, counts.

    A key's time is cut into slices of ``slices`` times ``within``, worked on apart, so that
    a key with very many rows is many groups; a slice also sees the ``within`` after it. One
    shuffle and one sort: the chains of later steps are carried from each row to those
    before it. Rows without key or time are in no match; a condition that is NULL is not met.
    """
    if not steps:
        raise ValueError("a sequence needs a step")
    span = _micros(within)
    length = span * slices
    met = [F.coalesce(F.expr(step), F.lit(False)).alias(f"met_{i}") for i, step in enumerate(steps)]
    known = rows[sql_name(key)].isNotNull() & rows[sql_name(at)].isNotNull()
    used = rows.where(known).select(
        F.col(sql_name(key)).alias("key"), F.unix_micros(sql_name(at)).alias("us"), F.col(sql_name(order)).alias("id"), *met
    )
    used = used.withColumn("home", F.expr(f"(us - pmod(us, {length}L)) div {length}L"))
    if not strict:  # rows that meet no step are passed over anyway
        used = used.where(" OR ".join(f"met_{i}" for i in range(len(steps))))
    early = F.expr(f"pmod(us, {length}L) < {span + 1}L")
    used = used.withColumn("slice", F.explode(F.when(early, F.array("home", F.col("home") - 1)).otherwise(F.array("home"))))
    # Backwards in time: what follows a row lies before it, and a growing frame is one pass.
    backwards = Window.partitionBy("key", "slice").orderBy(F.desc("us"), F.desc("id"))
    after = backwards.rowsBetween(-1, -1) if strict else backwards.rowsBetween(Window.unboundedPreceding, -1)
    row = F.struct("us", "id")
    chained = used.withColumn("chain", F.when(F.col(f"met_{len(steps) - 1}"), F.array(row)))
    for i in reversed(range(len(steps) - 1)):
        chained = chained.withColumn("next", F.last("chain", ignorenulls=not strict).over(after))
        chained = chained.withColumn(
            "chain", F.when(F.col(f"met_{i}") & F.col("next").isNotNull(), F.concat(F.array(row), F.col("next")))
        )
    found = chained.where(F.col("chain").isNotNull() & (F.col("slice") == F.col("home"))).where(
        F.element_at("chain", -1)["us"] - F.col("us") <= span
    )
    return found.select(
        F.col("key").alias(key), *[F.col("chain")[i]["id"].alias(f"step_{i + 1}") for i in range(len(steps))]
    )


# Moments in whole units: sums are exact, so they merge in any order to the same numbers.


def moments(rows: DataFrame, keys: Sequence[str | Column], value: str, unit: str = "1") -> DataFrame:
    """Per ``keys``: n, s and q, the count, sum and sum of squares of ``value`` in whole ``unit``s, rounded.

    The only error is that rounding, half a unit a value. NULL, infinite and NaN values are
    left out. Summaries of parts of a table add up to that of the table (``merged``). A value
    beyond 10^12 units is an error.
    """
    return rows.where(_finite(value)).groupBy(*keys).agg(*_sums(_units(value, unit)))


def merged(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One summary per ``keys`` from those of ``moments``."""
    return parts.groupBy(*keys).agg(*[F.sum(name).cast(parts.schema[name].dataType).alias(name) for name in "nsq"])


def anomalies(
    rows: DataFrame,
    source: str,
    at: str,
    value: str,
    size: timedelta,
    history: int,
    sigmas: int,
    unit: str = "1",
    least: int = 2,
) -> DataFrame:
    """``rows`` whose ``value`` is over ``sigmas`` deviations from the mean of their source's ``history`` windows before.

    Windows have ``size`` and begin at the epoch; ``past_n`` counts the values of those
    before the row's own, of which there must be ``least``. Means and deviations are
    compared in whole units without division, so the outcome is exact for values in units.
    Rows without source, time or a finite value are no anomalies. Tasks reduce their rows to
    one summary per source and window before the shuffle.
    """
    length = _micros(size)
    timed = rows.where(_finite(value) & F.col(sql_name(source)).isNotNull() & F.col(sql_name(at)).isNotNull())
    numbered = timed.withColumn("__us", F.unix_micros(sql_name(at))).withColumn("__x", _units(value, unit))
    numbered = numbered.withColumn("__window", F.expr(f"(__us - pmod(__us, {length}L)) div {length}L"))
    per = numbered.groupBy(F.col(sql_name(source)).alias("__source"), F.col("__window").alias("__w")).agg(*_sums(F.col("__x")))
    before = Window.partitionBy("__source").orderBy("__w").rangeBetween(-history, -1)
    past = per.select("__source", "__w", *[F.sum(c).over(before).cast("decimal(38,0)").alias(f"__{c}") for c in "nsq"])
    joined = numbered.join(past, (F.col(sql_name(source)) == F.col("__source")) & (F.col("__window") == F.col("__w")))
    far = f"(__n * __x - __s) * (__n * __x - __s) > {sigmas * sigmas} * (__n * __q - __s * __s)"
    found = joined.where(f"__n >= {least}").where(far)
    return found.select(*[rows[sql_name(c)] for c in rows.columns], F.col("__n").cast("long").alias("past_n"))


def _finite(value: str) -> Column:
    number = F.col(sql_name(value)).cast("double")
    return number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf")))


def _units(value: str, unit: str) -> Column:
    return F.expr(f"cast(round({sql_name(value)} / {unit}) AS decimal(12,0))")


def _sums(x: Column) -> list[Column]:
    return [F.count("*").alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q")]
