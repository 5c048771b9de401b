"""Continuous ingest: documents to accepted events, dead letters and staging upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.operators import ingest
from kinweave.sources.events import parse_documents, read_tracking_events
from kinweave.streaming.store import append_upserts


def ingest_stream(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """Routed documents of a file stream (use ``routed`` on a Kafka stream's value column)."""
    return ingest.route_ingest(read_tracking_events(spark, path, fmt, stream=True))


def routed(stream: DataFrame, body: str = "value") -> DataFrame:
    return ingest.route_ingest(parse_documents(stream.select(body), body), body)


def staging_rows(batch: DataFrame) -> DataFrame:
    """Last staging row per visitor of a micro-batch; bad contacts are left out."""
    ok = ingest.classify_records(ingest.accepted(batch)).where("record_state = 'Ok'")
    return ingest.staging_rows(ok, F.col("datetime"), ["datetime", "event_id"])


def start_ingest(stream: DataFrame, accepted_path: str, dead_letter_path: str, staging_path: str, checkpoint: str,
                 trigger: dict | None = None):
    """Write every micro-batch to three sinks. The folders are named by batch, so a replay rewrites them exactly.

    A batch is held parsed; ``documents_split`` around the running query keeps its parts small whatever the files' sizes are.
    """
    def flush(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append_upserts(ingest.accepted(batch), accepted_path, batch_id)
            append_upserts(ingest.dead_letter(batch), dead_letter_path, batch_id)
            append_upserts(staging_rows(batch), staging_path, batch_id)
        finally:
            batch.unpersist()
    return stream.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).start()
