"""A range of batches read again from the positions of a checkpoint."""

import json
import os

import pytest

from tidemark.sinks.files import land_text
from tidemark.sources.files import text_values
from tidemark.streaming.control import StreamControl, finish
from tidemark.streaming.replay import batches, kafka_range, position, replayed_files, span


def test_replay_of_files_equals_the_first_landing(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    inbox.mkdir()
    for i in range(12):  # beyond the tenth entry the log is compacted
        file = inbox / f"{i:03}.txt"
        file.write_text(f"{i}\n{i}é\n")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    values = text_values(spark, str(inbox), streaming=True, maxFilesPerTrigger=1)
    finish(land_text(values, out, StreamControl(checkpoint, available_now=True)))
    assert batches(spark, checkpoint) == list(range(12))

    def lines(first, last):
        files = replayed_files(spark, checkpoint, first, last)
        return sorted(r.value for r in spark.read.text(files).collect())

    assert lines(0, 11) == sorted(r.value for r in text_values(spark, out).collect())
    assert lines(3, 4) == ["3", "3é", "4", "4é"]
    assert lines(0, 0) == ["0", "0é"]
    assert position(spark, checkpoint, 5) == {"logOffset": 5}
    for first, last in [(4, 3), (-1, 2), (0, 12), (13, 14)]:
        with pytest.raises(ValueError):
            span(spark, checkpoint, first, last)


def test_position_of_a_topic(spark, tmp_path):
    for folder in ("offsets", "commits"):
        (tmp_path / folder).mkdir()
    saved = [{"t": {"0": 5}}, {"t": {"0": 9, "1": 4}}]
    for i, end in enumerate(saved):
        (tmp_path / "offsets" / str(i)).write_text(f'v1\n{{"batchWatermarkMs":0}}\n{json.dumps(end)}')
        (tmp_path / "commits" / str(i)).write_text("v1\n{}")
    (tmp_path / "offsets" / "2").write_text('v1\n{}\n{"t":{"0":11}}')  # begun, not ended
    assert batches(spark, str(tmp_path)) == [0, 1]
    options = kafka_range(*span(spark, str(tmp_path), 1, 1))
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 5, "1": -2}}
    assert json.loads(options["endingOffsets"]) == saved[1]
    assert json.loads(kafka_range(None, saved[0])["startingOffsets"]) == {"t": {"0": -2}}
    with pytest.raises(ValueError):
        span(spark, str(tmp_path), 1, 2)
