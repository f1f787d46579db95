"""Job parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from tidemark.schema import KEY_COUNT, KEY_PREFIX
from tidemark.sinks.rolling import RollingPolicy
from tidemark.sources.kafka import KafkaConfig
from tidemark.streaming.control import StreamControl

# The names of the jobs' consumer groups. Brokers grant access by
# group name or by its prefix. Each query gets a group of its own that begins with
# the name, because queries that share a group may each be given a part of the data.
GROUP_IDS = {
    "raw": "flink-group",
    "filtered": "flink-cdp-json",
    "flat": "flink-kafka-group",
}


@dataclass(frozen=True)
class LandingJob:
    """What every landing job needs: where to read, where to write, how to run.

    ``kafka`` may be left out when the job function is given a frame of values.
    ``checkpoint`` defaults to a folder next to the output. ``invalid`` says what
    becomes of bytes from Kafka that are not UTF-8: replace, null or keep.
    """

    output_path: str
    kafka: KafkaConfig | None = None
    checkpoint: str | None = None
    name: str | None = None
    interval: str | None = None
    available_now: bool = False
    compression: str = "none"
    invalid: str = "replace"
    policy: RollingPolicy = field(default_factory=RollingPolicy)

    def __post_init__(self) -> None:
        if not self.output_path:
            raise ValueError("output_path is required")

    def control(self, default_name: str) -> StreamControl:
        checkpoint = self.checkpoint or self.output_path.rstrip("/") + "_checkpoint"
        return StreamControl(
            checkpoint, self.name or default_name, self.interval, self.available_now
        )


@dataclass(frozen=True)
class FlatLandingJob(LandingJob):
    """A landing job for decoded records; the numbered fields may be changed."""

    key_prefix: str = KEY_PREFIX
    key_count: int = KEY_COUNT
