"""Extension: the keyed upsert fed by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from oreline.operators.tables import VersionedTable


def stream_upsert(
    changes: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    order: list[str],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge each micro-batch into ``table``; of one key's changes the last by ``order`` wins.

    A batch that is replayed after a failure is recognised by its number and
    skipped, so the table sees every batch once. One stream per table. Batches
    hold whatever arrived, so order between batches is the order of arrival.
    """

    def merge(batch: DataFrame, number: int) -> None:
        table.upsert(batch, on_duplicate="latest", order=order, batch=number)

    return (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
