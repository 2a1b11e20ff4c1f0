"""Incremental ingest: documents that arrive in a folder or table become index runs."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from docquery.hooks import Hook
from docquery.settings import DEFAULTS, Settings
from docquery.sources.index import write_index


def start_ingest(
    documents: DataFrame, path: str, checkpoint: str, embedder: Hook, settings: Settings = DEFAULTS
) -> StreamingQuery:
    """Add each micro-batch of `(source, text)` to the index as a run of its own.

    The run is named after the batch, so a repeated batch replaces its own rows.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_index(batch, path, embedder, settings, run=f"batch-{batch_id}")
        finally:
            batch.unpersist()

    return (
        documents.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
