"""Latest state per record: of all changes of one key, the last one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sql import sql_name

KEY = "payload_sys_id"
ORDER = ("timestamp",)
OPERATION = "operation"
DELETE = "delete"


def latest(changes: DataFrame, key: str = KEY, order: Sequence[str] = ORDER) -> DataFrame:
    """One row per ``key``: the change that is last by the columns ``order``, say event time and offset.

    A NULL in ``order`` comes before all values. Changes equal in all of ``order`` are told
    apart by their other columns, so that late, repeated and reordered input gives the same
    state. Changes without a key are of no record and left out. A task reduces what it has
    read to one row per key before the shuffle, so a key of very many changes is no hot key.
    """
    rest = [name for name in changes.columns if name not in {key, *order}]
    whole = F.struct(*[changes[sql_name(name)] for name in [*order, *rest]]).alias("last")
    rows = changes.where(changes[sql_name(key)].isNotNull()).groupBy(changes[sql_name(key)].alias(key)).agg(F.max(whole).alias("last"))
    return rows.select(*[sql_name(name) if name == key else F.col("last").getField(name).alias(name) for name in changes.columns])


def merge_latest(
    snapshot: DataFrame, changes: DataFrame, key: str = KEY, order: Sequence[str] = ORDER
) -> DataFrame:
    """The state after ``changes`` on top of ``snapshot``, the state before; columns of one name are one.

    A change older than what the snapshot has is late and changes nothing. Deletes stay in
    the state as their last change, or a late update would bring the record back; ``live``
    leaves them out.
    """
    return latest(snapshot.unionByName(changes), key, order)


def live(state: DataFrame, operation: str = OPERATION) -> DataFrame:
    """The records of a state that are not deleted; an unknown operation is no delete."""
    return state.where(~state[sql_name(operation)].eqNullSafe(DELETE))
