import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators.decode import decode_changes
from tidemark.operators.latest import latest, live, merge_latest
from tidemark.schema import change_schema, narrow
from tidemark.sinks.files import land_json, land_text
from tidemark.sinks.rolling import RollingPolicy
from tidemark.sinks.versions import KEPT, REJECTED, keep_snapshot, land_with_rejects, landed, snapshot
from tidemark.sources.files import parquet_stream
from tidemark.streaming.control import StreamControl, finish

CHANGES = "payload_sys_id string, timestamp long, offset long, operation string, note string"
ORDER = ("timestamp", "offset")
ROWS = [
    ("a", 1, 1, "insert", "x"),
    ("a", 3, 4, "update", "y"),
    ("a", 3, 4, "update", "y"),
    ("a", 2, 9, "update", "late"),
    ("b", 5, 2, "insert", None),
    ("b", 5, 7, "delete", None),
    ("b", 4, 8, "update", "late"),
    ("c", None, 3, "insert", "no time"),
    ("c", None, 2, None, "earlier"),
    (None, 9, 9, "insert", "no key"),
]


def lose_commit(checkpoint, number):
    for name in (f"{number}", f".{number}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


STATE = {("a", 3, 4, "update", "y"), ("b", 5, 7, "delete", None), ("c", None, 3, "insert", "no time")}


def test_latest_whatever_the_order_of_input(spark):
    for rows in (ROWS, ROWS[::-1]):
        got = latest(spark.createDataFrame(rows, CHANGES).repartition(3), order=ORDER)
        assert got.columns == [x.split()[0] for x in CHANGES.split(", ")]
        assert {tuple(r) for r in got.collect()} == STATE
    assert {r.payload_sys_id for r in live(got).collect()} == {"a", "c"}
    assert latest(got.where(F.lit(False)), order=ORDER).count() == 0


def test_equal_order_is_settled_by_the_other_columns(spark):
    rows = [("a", 1, 1, "update", n) for n in ("p", "q", None)]
    got = {latest(spark.createDataFrame(rows[k:] + rows[:k], CHANGES), order=ORDER).first().note for k in range(3)}
    assert got == {"q"}


@pytest.mark.parametrize("cut", range(0, len(ROWS) + 1, 3))
def test_merge_in_two_parts_equals_one(spark, cut):
    first, second = (spark.createDataFrame(x, CHANGES) for x in (ROWS[:cut], ROWS[cut:]))
    assert {tuple(r) for r in merge_latest(latest(first, order=ORDER), second, order=ORDER).collect()} == STATE


def test_snapshot_over_batches_and_after_a_lost_commit(spark, tmp_path):
    source, state, checkpoint = (str(tmp_path / x) for x in ("in", "state", "checkpoint"))
    schema = spark.createDataFrame([], CHANGES).schema

    def run():
        stream = parquet_stream(spark, source, schema, max_files_per_trigger=1)
        finish(keep_snapshot(stream, state, StreamControl(checkpoint, available_now=True), order=ORDER))

    for k in range(0, len(ROWS), 4):
        spark.createDataFrame(ROWS[k : k + 4], CHANGES).coalesce(1).write.mode("append").parquet(source)
        run()
    assert {tuple(r) for r in snapshot(spark, state, schema).collect()} == STATE
    last = max(int(x) for x in os.listdir(f"{checkpoint}/commits") if x.isdigit())
    lose_commit(checkpoint, last)
    run()
    assert {tuple(r) for r in snapshot(spark, state, schema).collect()} == STATE
    assert snapshot(spark, str(tmp_path / "none"), schema).count() == 0


VALUES = ['{"type":"t","timestamp":1}', "not json", '["x"]', "", None, '{"timestamp":"n/a"}', '{"type":"u"']


def test_every_record_is_kept_or_rejected(spark, tmp_path):
    schema = narrow(change_schema(), "type", "timestamp")
    values = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "n long, value string")
    rows = decode_changes(values, schema, keep=("n",), rejects=True)
    assert rows.columns == ["n", "type", "timestamp", "rejected"]
    plain = decode_changes(values, schema, keep=("n",)).collect()
    assert [tuple(r)[:3] for r in rows.where("rejected IS NULL").collect()] == [tuple(r) for r in plain]
    assert {r.n: r.rejected for r in rows.where("rejected IS NOT NULL").collect()} == {
        i: v or "" for i, v in enumerate(VALUES) if i not in {r.n for r in plain}
    }
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    values.write.parquet(str(tmp_path / "in"))

    def run():
        stream = parquet_stream(spark, str(tmp_path / "in"), values.schema)
        finish(land_with_rejects(stream, schema, path, StreamControl(checkpoint, available_now=True), keep=("n",)))

    run()
    lose_commit(checkpoint, 0)
    run()
    number = values.select("n").schema
    kept, rejected = ({r.n for r in landed(spark, path, number, x).collect()} for x in (KEPT, REJECTED))
    assert kept == {0, 5} and rejected == {1, 2, 3, 4, 6}
    assert sum(landed(spark, path, number, x).count() for x in (KEPT, REJECTED)) == len(VALUES)
    land_with_rejects(values.where("n = 0"), schema, str(tmp_path / "batch"))
    assert landed(spark, str(tmp_path / "batch"), number, REJECTED).count() == 0


def sizes(path):
    """Sizes of the files of each task, in their order."""
    tasks = {}
    for roll in os.listdir(path):
        if roll.startswith("roll="):
            for name in os.listdir(f"{path}/{roll}"):
                if name.startswith("part-"):
                    tasks.setdefault(name.split("-")[1], {})[int(roll[5:])] = os.path.getsize(f"{path}/{roll}/{name}")
    return [[size for _, size in sorted(task.items())] for task in tasks.values()]


def test_files_roll_within_one_record_of_the_target(spark, tmp_path):
    target, large = 400_000, 100_001
    mixed = spark.range(3000).select(
        F.when(F.col("id") % 100 == 7, F.repeat(F.lit("x"), large - 1)).otherwise(F.repeat(F.lit("y"), 29)).alias("value")
    )
    policy = RollingPolicy(max_part_bytes=target, by_bytes=True)
    land_text(mixed.repartition(2), str(tmp_path / "text"), policy=policy)
    found = sizes(tmp_path / "text")
    assert len(found) == 2 and all(len(task) > 2 for task in found)
    assert all(abs(size - target) <= large for task in found for size in task[:-1])
    assert all(task[-1] <= target + large for task in found)
    assert sum(map(sum, found)) == 30 * large + 2970 * 30
    rows = spark.range(2000).select("id", F.when(F.col("id") % 2 == 0, F.lit("é")).alias("note"))
    land_json(rows, str(tmp_path / "json"), policy=RollingPolicy(max_part_bytes=5000, by_bytes=True))
    back = spark.read.schema("id long, note string").json(str(tmp_path / "json"))
    assert sorted((r.id, r.note) for r in back.collect()) == [(i, "é" if i % 2 == 0 else None) for i in range(2000)]
    with open(next((tmp_path / "json").glob("roll=0/part-*"))) as file:
        assert set(json.loads(file.readline())) == {"id", "note"}
