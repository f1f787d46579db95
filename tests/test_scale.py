"""Facts about plans and files that decide how the jobs behave on large data."""

import gzip
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import plan_of

from tidemark.queries.catalog import CATALOG
from tidemark.sinks.rolling import RollingPolicy
from tidemark.streaming import workspace as ws

BATCH_WITHOUT_AGGREGATION = [
    "json_table_source",
    "json_missing_field",
    "json_skip_malformed",
    "json_bad_field_null",
    "json_encode",
    "json_document_round_trip",
    "project_envelope",
    "project_nested",
    "flatten_record",
    "flatten_generated",
    "flatten_generated_few",
    "json_has_keys",
    "json_has_null_key",
    "bytes_to_text",
    "gen_change_records",
    "gen_mixed_text",
]


@pytest.mark.parametrize("name", BATCH_WITHOUT_AGGREGATION)
def test_no_shuffle(spark, sf_dir, name):
    plan = plan_of(CATALOG[name].run(spark, sf_dir))
    assert "Exchange" not in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "Broadcast" not in plan


def test_null_share_shuffles_one_row_per_task(spark, sf_dir):
    plan = plan_of(CATALOG["gen_null_share"].run(spark, sf_dir))
    assert "partial_" in plan
    assert "SinglePartition" in plan


def test_a_declared_source_parses_the_named_columns(spark, sf_dir):
    plan = plan_of(CATALOG["sql_source_select"].run(spark, sf_dir))
    parsed = plan.split("from_json(")[1].split("_unparsed")[0]
    assert "StructField(type," in parsed and "StructField(asset," in parsed
    assert "key_1" not in parsed and "Exchange" not in plan


@pytest.mark.parametrize("name", ["project_envelope", "json_skip_malformed"])
def test_only_needed_columns_are_read(spark, sf_dir, name):
    plan = plan_of(CATALOG[name].run(spark, sf_dir))
    assert "value:double" not in plan and "props:" not in plan


def test_files_go_to_the_shared_folder(spark, sf_dir):
    shared = Path(spark.conf.get(ws.SETTING))
    before = set(shared.glob("restart_no_duplicates-*"))
    assert CATALOG["restart_no_duplicates"].run(spark, sf_dir).count() > 0
    (made,) = set(shared.glob("restart_no_duplicates-*")) - before
    assert {p.name for p in made.iterdir()} == {"landed", "checkpoint"}


def landed_files(spark, purpose, run):
    """The files that a query has landed in a folder of its own, and its number of rows."""
    shared = Path(spark.conf.get(ws.SETTING))
    before = set(shared.glob(f"{purpose}-*"))
    rows = run().count()
    (made,) = set(shared.glob(f"{purpose}-*")) - before
    return [p for p in (made / "landed").rglob("part-*") if not p.name.endswith(".crc")], rows


def test_the_generator_job_lands_compressed(spark, sf_dir):
    files, rows = landed_files(spark, "gen_job", lambda: CATALOG["gen_job_landing"].run(spark, sf_dir))
    plain = sum(len(gzip.decompress(p.read_bytes())) for p in files)
    assert rows == 1500 and plain > 3000 * rows
    assert sum(p.stat().st_size for p in files) < 0.52 * plain


def test_flat_json_lands_compressed_in_rolled_files(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(RollingPolicy, "options", lambda policy: {"maxRecordsPerFile": str(int(5e5 / policy.record_bytes))})
    files, rows = landed_files(spark, "json_landing", lambda: CATALOG["json_landing"].run(spark, sf_dir))
    plain = [len(gzip.decompress(p.read_bytes())) for p in files]
    assert sum(p.stat().st_size for p in files) < 0.45 * sum(plain)
    assert rows > 500 and len(plain) > 3 and max(plain) < 1.1 * 5e5


def test_generated_lines_are_made_once_and_land_small(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(RollingPolicy, "measured", lambda *_: pytest.fail("the lines were made to be measured"))
    files, rows = landed_files(spark, "gen_landing", lambda: CATALOG["gen_landing"].run(spark, sf_dir))
    lines = b"".join(gzip.decompress(p.read_bytes()) for p in files)
    assert rows == 1500 == lines.count(b"\n")
    assert sum(p.stat().st_size for p in files) < 0.375 * len(lines)


def test_every_run_has_its_own_folder(spark):
    assert ws.workspace(spark, "x") != ws.workspace(spark, "x")


def session(master, **settings):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: settings.get(name, default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_shared_root_is_the_cluster_setting():
    assert ws.shared_root(session("yarn", **{ws.SETTING: "hdfs:///c/"})) == "hdfs:///c"
    assert ws.shared_root(session("local[2]", **{ws.SETTING: "/mnt/c"})) == "/mnt/c"


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(ValueError, match=ws.SETTING):
        ws.shared_root(session("yarn"))
    assert Path(ws.shared_root(session("local[2]"))).is_dir()
