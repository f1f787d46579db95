"""How a stream runs: its checkpoint, name and trigger."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


@dataclass(frozen=True)
class StreamControl:
    """Settings of one streaming query.

    The checkpoint holds the source position of every batch and is never removed
    when the query stops, so starting again on it continues where it ended. With
    a source that can be read again and the file sink's own batch log, each
    record is in the landed data once.

    ``available_now`` handles what is there and ends; otherwise the query runs
    with ``interval`` between batches (by default the sink's rolling interval).
    """

    checkpoint: str
    name: str | None = None
    interval: str | None = None
    available_now: bool = False

    def __post_init__(self) -> None:
        if not self.checkpoint:
            raise ValueError("checkpoint is required")
        if self.available_now and self.interval:
            raise ValueError("give interval or available_now, not both")

    def trigger(self, default_interval: str | None = None) -> dict[str, object]:
        if self.available_now:
            return {"availableNow": True}
        interval = self.interval or default_interval
        return {"processingTime": interval} if interval else {}

    def configure(
        self, writer: DataStreamWriter, default_interval: str | None = None
    ) -> DataStreamWriter:
        writer = writer.outputMode("append").option("checkpointLocation", self.checkpoint)
        if self.name:
            writer = writer.queryName(self.name)
        trigger = self.trigger(default_interval)
        return writer.trigger(**trigger) if trigger else writer


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query to end; a failure of the query is raised here."""
    query.awaitTermination()
    return query
