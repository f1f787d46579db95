import gzip
import json
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators.generate import change_records
from tidemark.operators.encode import encode_rows
from tidemark.operators.project import flatten
from tidemark.plans.config import FlatLandingJob, LandingJob
from tidemark.plans.jobs import generate_changes, land_filtered, land_flat_json, land_raw
from tidemark.schema import change_schema, flat_schema
from tidemark.sinks.files import land_json, land_text
from tidemark.sinks.rolling import MIB, RollingPolicy
from tidemark.sinks.tables import by_position, create_json_table, insert_select
from tidemark.sources.files import json_rows, text_values
from tidemark.sources.views import source_view
from tidemark.streaming.control import StreamControl, finish


def data_files(path):
    return [p for p in Path(path).rglob("part-*") if not p.name.endswith(".crc")]


def landed(spark, path):
    return sorted(row.value for row in text_values(spark, str(path)).collect())


def job_for(tmp_path, kind=LandingJob, **settings):
    return kind(
        str(tmp_path / "out"),
        checkpoint=str(tmp_path / "checkpoint"),
        available_now=True,
        **settings,
    )


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def add(name, *lines):
        (folder / name).write_bytes("".join(f"{line}\n" for line in lines).encode())

    add.path = str(folder)
    return add


# Rolling policy and triggers


def test_policy_defaults():
    policy = RollingPolicy()
    assert policy.interval == "15 minutes"
    assert policy.max_part_bytes == 128 * MIB
    assert policy.options() == {} and policy.max_records() is None
    assert RollingPolicy(record_bytes=1024).options() == {"maxRecordsPerFile": str(128 * 1024)}
    with pytest.raises(ValueError):
        RollingPolicy(record_bytes=0)


def test_default_trigger_is_the_roll_interval():
    assert StreamControl("/c").trigger("15 minutes") == {"processingTime": "15 minutes"}
    assert StreamControl("/c", interval="10 seconds").trigger("15 minutes") == {
        "processingTime": "10 seconds"
    }
    assert StreamControl("/c", available_now=True).trigger("15 minutes") == {"availableNow": True}
    with pytest.raises(ValueError):
        StreamControl("/c", interval="1 minute", available_now=True)
    with pytest.raises(ValueError):
        StreamControl("")


def full_files(path):
    """Sizes of the files, without the last of each task."""
    tasks = {}
    for p in data_files(path):
        tasks.setdefault(p.name.split("-")[1], []).append((p.name, p.stat().st_size))
    return [size for files in tasks.values() for _, size in sorted(files)[:-1]]


@pytest.mark.parametrize("kind", ["short", "long", "mixed", "json"])
def test_a_batch_rolls_at_its_target_whatever_the_records(spark, tmp_path, kind):
    target = 100_000
    short, long = F.format_string("%029d", "id"), F.rpad(F.col("id").cast("string"), 3300, "x")
    ids = spark.range(0, 20_000 if kind == "short" else 1_000, 1, 2)
    policy = RollingPolicy(max_part_bytes=target)
    if kind == "json":
        land_json(flatten(change_records(ids, count=30)), str(tmp_path / "out"), policy=policy)
    else:
        mixed = F.when(F.xxhash64("id") % 3 == 0, long).otherwise(short)
        value = {"short": short, "long": long, "mixed": mixed}[kind]
        land_text(ids.select(value.alias("value")), str(tmp_path / "out"), policy=policy)
    sizes = full_files(tmp_path / "out")
    assert len(sizes) > 3 and all(0.5 * target <= size <= 1.5 * target for size in sizes)
    assert text_values(spark, str(tmp_path / "out")).count() == ids.count()


def test_a_stream_rolls_by_measured_records(spark, tmp_path, inbox):
    inbox("a", *[f"{i:029d}" for i in range(9_000)])
    policy = RollingPolicy(max_part_bytes=50_000).measured(text_values(spark, inbox.path))
    assert policy.record_bytes == 30
    job = job_for(tmp_path, policy=policy)
    finish(land_raw(spark, job, text_values(spark, inbox.path, streaming=True)))
    sizes = [p.stat().st_size for p in data_files(job.output_path)]
    uneven = [size for size in sizes if not 0.5 * 50_000 <= size <= 1.5 * 50_000]
    assert len(sizes) > 3 and len(uneven) <= 1  # the last of the one task
    assert len(landed(spark, job.output_path)) == 9_000


def test_a_bounded_batch_defers_and_drops_nothing(spark, tmp_path, inbox):
    job = job_for(tmp_path)
    for i in range(7):
        inbox(f"f{i}", f"{i}a", f"{i}b")

    def run():
        query = land_raw(spark, job, text_values(spark, inbox.path, streaming=True, maxFilesPerTrigger=2))
        return finish(query)

    assert len([p for p in run().recentProgress if p["numInputRows"]]) == 4
    want = sorted(f"{i}{c}" for i in range(7) for c in "ab")
    assert landed(spark, job.output_path) == want
    # As if it had been stopped after the first batch.
    for folder in ("commits", "offsets", "sources/0"):
        for p in (Path(job.checkpoint) / folder).iterdir():
            if p.name.lstrip(".").split(".")[0] not in ("0", "metadata"):
                p.unlink()
    run()
    assert landed(spark, job.output_path) == want


def test_size_cap_splits_files(spark, tmp_path):
    rows = spark.range(0, 1000, 1, 1).select(F.format_string("%099d", "id").alias("value"))
    path = tmp_path / "out"
    land_text(rows, str(path), policy=RollingPolicy(max_part_bytes=10_000, record_bytes=100))
    sizes = [p.stat().st_size for p in data_files(path)]
    assert len(sizes) == 10
    assert max(sizes) <= 10_000
    assert text_values(spark, str(path)).count() == 1000


def test_size_cap_on_a_stream(spark, tmp_path, inbox):
    inbox("a", *[f"{i:09d}" for i in range(100)])
    job = job_for(tmp_path, policy=RollingPolicy(max_part_bytes=250, record_bytes=10))
    finish(land_raw(spark, job, text_values(spark, inbox.path, streaming=True)))
    assert len(data_files(job.output_path)) == 4
    assert len(landed(spark, job.output_path)) == 100


def test_rebalance_merges_small_partitions(spark, tmp_path):
    rows = spark.range(0, 400, 1, 40).select(F.col("id").cast("string").alias("value"))
    plain, merged = tmp_path / "plain", tmp_path / "merged"
    land_text(rows, str(plain))
    land_text(rows, str(merged), policy=RollingPolicy(rebalance=True))
    assert len(data_files(plain)) == 40
    assert len(data_files(merged)) < 5
    assert landed(spark, plain) == landed(spark, merged)


def test_default_landing_has_no_shuffle(spark, tmp_path, inbox):
    inbox("a", "x")
    query = finish(
        land_raw(spark, job_for(tmp_path), text_values(spark, inbox.path, streaming=True))
    )
    plan = query._jsq.explainInternal(False)
    assert "Exchange" not in plan and "Python" not in plan


# Text and JSON


def test_any_text_is_kept(spark, tmp_path, values):
    texts = ["", " ", "{", "ü😀", "a\rb", "tab\t", '{"a":1}', "x" * 100_000]
    land_text(values(*texts), str(tmp_path / "out"))
    assert landed(spark, tmp_path / "out") == sorted(texts)


def test_line_ends_inside_a_record_make_more_lines(spark, tmp_path, values):
    land_text(values("a\nb"), str(tmp_path / "out"))
    assert landed(spark, tmp_path / "out") == ["a", "b"]


def test_json_file_has_explicit_nulls_in_order(spark, tmp_path):
    rows = flatten(change_records(spark.range(20)))
    land_json(rows, str(tmp_path / "out"))
    lines = [json.loads(line) for line in landed(spark, tmp_path / "out")]
    assert len(lines) == 20
    assert all(list(line) == flat_schema().names for line in lines)
    assert all(line["aliases"] is None for line in lines)


def test_compression(spark, tmp_path, values):
    land_text(values("hello").coalesce(1), str(tmp_path / "out"), compression="gzip")
    (file,) = data_files(tmp_path / "out")
    assert gzip.decompress(file.read_bytes()) == b"hello\n"


def test_batch_appends(spark, tmp_path, values):
    for text in ("a", "b"):
        land_text(values(text), str(tmp_path / "out"))
    assert landed(spark, tmp_path / "out") == ["a", "b"]


def test_stream_needs_control(spark, tmp_path, inbox):
    inbox("a", "x")
    with pytest.raises(ValueError):
        land_text(text_values(spark, inbox.path, streaming=True), str(tmp_path / "out"))


# Jobs, and delivery without duplicates


def test_raw_job(spark, tmp_path, inbox):
    lines = ["{", "not json", '{"a":1}', "", "cr\r"]
    inbox("a", *lines)
    job = job_for(tmp_path, name="my job")
    query = finish(land_raw(spark, job, text_values(spark, inbox.path, streaming=True)))
    assert query.name == "my job"
    assert landed(spark, job.output_path) == sorted(lines)


def test_filtered_job(spark, tmp_path, inbox):
    inbox("a", '{"eventTime":1,"message":2}', '{"eventTime":1}', "bad", '{"k":1}')
    values = text_values(spark, inbox.path, streaming=True)
    job = job_for(tmp_path)
    finish(land_filtered(spark, job, values))
    assert landed(spark, job.output_path) == ['{"eventTime":1,"message":2}']
    other = LandingJob(str(tmp_path / "k"), checkpoint=str(tmp_path / "ck"), available_now=True)
    finish(land_filtered(spark, other, values, keys=("k",)))
    assert landed(spark, other.output_path) == ['{"k":1}']


def test_flat_job(spark, tmp_path, inbox):
    inbox("a", '{"type":"r","timestamp":5,"data":{"key_2":"v"}}', "bad", "{}", '{"data":1}')
    job = job_for(tmp_path, FlatLandingJob, key_count=3)
    finish(land_flat_json(spark, job, text_values(spark, inbox.path, streaming=True)))
    rows = json_rows(spark, job.output_path, flat_schema(count=3)).collect()
    assert sorted((r.type or "", r.timestamp or 0, r.key_2 or "") for r in rows) == [
        ("", 0, ""),
        ("", 0, ""),
        ("r", 5, "v"),
    ]


def test_batch_and_stream_give_the_same(spark, tmp_path, inbox):
    inbox("a", *[row.value for row in encode_rows(change_records(spark.range(30))).collect()])
    stream_job = job_for(tmp_path, FlatLandingJob)
    finish(land_flat_json(spark, stream_job, text_values(spark, inbox.path, streaming=True)))
    batch_job = FlatLandingJob(str(tmp_path / "batch"))
    assert land_flat_json(spark, batch_job, text_values(spark, inbox.path)) is None
    assert landed(spark, stream_job.output_path) == landed(spark, batch_job.output_path)


def run_raw(spark, job, inbox):
    finish(land_raw(spark, job, text_values(spark, inbox.path, streaming=True)))
    return landed(spark, job.output_path)


def test_restart_continues(spark, tmp_path, inbox):
    job = job_for(tmp_path)
    inbox("a", "1", "2")
    assert run_raw(spark, job, inbox) == ["1", "2"]
    assert Path(job.checkpoint).is_dir()
    assert run_raw(spark, job, inbox) == ["1", "2"]
    inbox("b", "3")
    assert run_raw(spark, job, inbox) == ["1", "2", "3"]


def test_batch_run_again_after_a_lost_commit(spark, tmp_path, inbox):
    """The driver dies after the files of a batch are committed, before the batch is."""
    job = job_for(tmp_path)
    inbox("a", "1", "2")
    run_raw(spark, job, inbox)
    before_commit = tmp_path / "checkpoint_before_commit"
    shutil.copytree(job.checkpoint, before_commit, ignore=shutil.ignore_patterns("0", ".0.crc"))
    shutil.copytree(
        Path(job.checkpoint) / "offsets", before_commit / "offsets", dirs_exist_ok=True
    )
    shutil.copytree(
        Path(job.checkpoint) / "sources", before_commit / "sources", dirs_exist_ok=True
    )
    again = LandingJob(job.output_path, checkpoint=str(before_commit), available_now=True)
    assert run_raw(spark, again, inbox) == ["1", "2"]
    inbox("b", "3")
    assert run_raw(spark, again, inbox) == ["1", "2", "3"]


def test_job_without_a_source(spark, tmp_path):
    with pytest.raises(ValueError):
        land_raw(spark, job_for(tmp_path))


# Generator job


def test_generate_bounded(spark, tmp_path):
    job = LandingJob(str(tmp_path / "gen"))
    assert generate_changes(spark, job=job, records=25, seed=3) is None
    lines = landed(spark, job.output_path)
    assert len(lines) == 25
    assert list(json.loads(lines[0])) == change_schema().names
    with pytest.raises(ValueError):
        generate_changes(spark)


def test_a_generated_batch_is_drawn_once_and_rolls_at_its_target(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RollingPolicy, "measured", lambda *_: pytest.fail("the lines were made to be measured"))
    target = 100_000
    job = LandingJob(str(tmp_path / "gen"), policy=RollingPolicy(max_part_bytes=target))
    generate_changes(spark, job=job, ids=spark.range(0, 400, 1, 4), seed=3)
    sizes = full_files(job.output_path)
    assert len(sizes) > 3 and all(0.9 * target <= size <= 1.1 * target for size in sizes)
    assert len(set(landed(spark, job.output_path))) == 400


def test_every_run_makes_new_records(spark, tmp_path):
    ids = []
    for name in ("a", "b"):
        job = LandingJob(str(tmp_path / name))
        generate_changes(spark, job=job, records=20)
        ids += [json.loads(x)["payload_sys_id"] for x in landed(spark, job.output_path)]
    assert len(set(ids)) == 40
    with pytest.raises(ValueError):
        generate_changes(spark, job=job, records=2, ids=spark.range(2))


def test_generate_unbounded(spark, tmp_path):
    job = LandingJob(
        str(tmp_path / "gen"), checkpoint=str(tmp_path / "c"), interval="1 second"
    )
    query = generate_changes(spark, job=job, rows_per_second=20)
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if any(p["numInputRows"] for p in query.recentProgress):
                break
    finally:
        query.stop()
    lines = [json.loads(line) for line in landed(spark, job.output_path)]
    assert lines and all(line["timestamp"] > 1_600_000_000_000 for line in lines)
    assert len({line["payload_sys_id"] for line in lines}) == len(lines)


# SQL


def test_continuous_insert_select_by_position(spark, tmp_path, inbox):
    inbox("a", '{"type":"r","timestamp":7,"data":{"asset":"x"}}', "bad", '{"type":"s"}')
    values = text_values(spark, inbox.path, streaming=True)
    source_view(values, "kafka_source", change_schema())
    sink = flat_schema(count=0)
    sink = type(sink)([sink["payload_sys_id"], sink["timestamp"], sink["asset"]])
    create_json_table(spark, "landing_sink", sink, str(tmp_path / "table"))
    try:
        control = StreamControl(str(tmp_path / "c"), "insert", available_now=True)
        finish(
            insert_select(
                spark,
                "landing_sink",
                "SELECT type, `timestamp`, data.asset FROM kafka_source",
                control,
            )
        )
        rows = spark.table("landing_sink").collect()
        assert sorted(map(tuple, rows)) == [("r", 7, "x"), ("s", None, None)]
    finally:
        spark.sql("DROP TABLE landing_sink")
    assert '{"payload_sys_id":"s","timestamp":null,"asset":null}' in landed(
        spark, tmp_path / "table"
    )


def test_batch_insert_select(spark, tmp_path, values):
    source_view(values('{"type":"r"}'), "batch_source", change_schema(count=0))
    sink = flat_schema(count=0)
    create_json_table(spark, "batch_sink", type(sink)([sink["asset"]]), str(tmp_path / "t"))
    try:
        insert_select(spark, "batch_sink", "SELECT type FROM batch_source")
        assert [tuple(r) for r in spark.table("batch_sink").collect()] == [("r",)]
    finally:
        spark.sql("DROP TABLE batch_sink")


def test_insert_select_checks_shape(spark):
    schema = flat_schema(count=0)
    rows = spark.range(1).select(F.lit("a").alias("x"), F.lit(1).alias("y"))
    with pytest.raises(ValueError, match="columns"):
        by_position(rows, schema)
    with pytest.raises(ValueError, match="bigint"):
        by_position(rows, type(schema)([schema["type"], schema["timestamp"]]))
