"""Tables of few row groups, dealt over all cores as they are read."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tidemark.operators.generate import change_records
from tidemark.queries import inputs
from tidemark.queries.catalog import CATALOG


def keys(n):
    """Keys that repeat, with nulls between."""
    return [None if i % 11 == 0 else i // 3 for i in range(n)]


def write(path, n, row_group_size=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    table = pa.table({"o_orderkey": pa.array(keys(n), pa.int64()), "a `b`": [str(i) for i in range(n)], "wide": ["x" * 50] * n})
    pq.write_table(table, path, row_group_size=row_group_size)


@pytest.mark.parametrize("rows, group", [(1000, None), (1000, 90), (37, 5), (3, None), (1, None), (0, None)])
def test_every_row_once_in_its_order(spark, tmp_path, rows, group):
    write(tmp_path / "orders.parquet", rows, group)
    whole = inputs.table(spark, tmp_path, "orders")
    assert inputs.spread_table(spark, tmp_path, "orders").collect() == whole.collect()
    some = inputs.spread_table(spark, tmp_path, "orders", "`a ``b```", "o_orderkey")
    assert some.columns == ["a `b`", "o_orderkey"]
    assert [tuple(row) for row in some.collect()] == list(zip(map(str, range(rows)), keys(rows)))


def test_a_folder_of_files(spark, tmp_path):
    for part, rows in enumerate((500, 0, 20, 1)):
        write(tmp_path / "orders.parquet" / f"part-{part}.parquet", rows, 100)
    whole = inputs.table(spark, tmp_path, "orders")
    got = inputs.spread_table(spark, tmp_path, "orders")
    assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect())) and whole.count() == 521


def test_one_row_group_goes_to_all_cores_without_a_shuffle(spark, tmp_path):
    write(tmp_path / "orders.parquet", 4000)
    rows = inputs.spread_table(spark, tmp_path, "orders", "o_orderkey")
    changes = change_records(rows, row_id="o_orderkey", timestamp_ms=F.lit(0), keep=("o_orderkey",))
    plan = plan_of(changes)
    assert "Exchange" not in plan and "wide" not in plan
    # The drawing is planned once, not once a slice.
    assert plan.count("zip_with") == 1
    tasks = [row["count"] for row in changes.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 4000 and max(tasks) <= 4000 / spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("name", ["gen_change_records", "gen_mixed_text", "json_encode"])
def test_queries_read_their_tables_spread(spark, sf_dir, name):
    rows = CATALOG[name].run(spark, sf_dir)
    assert "Exchange" not in plan_of(rows)
    tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) >= spark.sparkContext.defaultParallelism
