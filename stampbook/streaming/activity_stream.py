"""The daily activity counts as a streaming job, kept current by the same upsert."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.query import StreamingQuery

from stampbook.sources import PeriodTable, VersionedTable, shared_folder, upsert


def day_counts(scans: DataFrame) -> DataFrame:
    """Scans and sales per day and channel of a batch."""
    return scans.groupBy(F.to_date("event_ts").alias("full_date"), "chnl_nm").agg(
        F.count(F.lit(1)).alias("num_transactions"), F.sum("sale_amt_inc_vat").alias("sales")
    )


def daily_activity(scans: DataFrame, lateness: str = "31 days") -> DataFrame:
    """Scans per day and channel from a stream; state is dropped ``lateness`` after the day ends.

    Works on a batch frame too, where the watermark has no effect.
    """
    return (
        scans.withWatermark("event_ts", lateness)
        .groupBy(F.window("event_ts", "1 day").alias("w"), "chnl_nm")
        .agg(F.count(F.lit(1)).alias("num_transactions"), F.sum("sale_amt_inc_vat").alias("sales"))
        .select(F.to_date("w.start").alias("full_date"), "chnl_nm", "num_transactions", "sales")
    )


def stream_into(
    counts: DataFrame,
    table: VersionedTable | PeriodTable,
    keys: tuple[str, ...],
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert each micro-batch's changed rows into ``table``.

    The query state is kept in ``checkpoint``, or under the cluster's shared
    folder in a place named after the table. The upsert is idempotent, so a batch replayed after a lost executor or a
    restart leaves the same table.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        if isinstance(table, PeriodTable):
            table.merge(batch, keys)
            return
        table.write(upsert(table.read(), batch, keys) if table.exists() else batch)

    root = table.path if isinstance(table, PeriodTable) else table.root
    return _started(counts.writeStream.outputMode("update"), merge, checkpoint or _checkpoint(counts, root), available_now)


def _checkpoint(stream: DataFrame, root: str) -> str:
    return f"{shared_folder(stream.sparkSession)}/streams/{re.sub(r"[^A-Za-z0-9._-]+", "_", root)}"


def _started(writer: DataStreamWriter, merge: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(merge)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def recounted_days(
    scans: DataFrame,
    archive: PeriodTable,
    counts: PeriodTable,
    ids: Sequence[str],
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Daily counts from a stream whose rows may be late by any time, or come twice.

    Each micro-batch is merged into ``archive`` by ``ids``, and the periods that it touches are counted again from
    there and replaced in ``counts``; nothing is dropped behind a watermark and no state is kept. Both tables have
    their periods by ``full_date``, of one grain. A batch replayed after a loss leaves the same tables.
    """

    def merge(batch: DataFrame, _batch_id: int) -> None:
        dated = batch.withColumn("full_date", F.to_date("event_ts")).dropDuplicates(list(ids))
        touched = archive.merge(dated, ids)
        if touched:
            counts.replace(touched, day_counts(archive.of(touched)))

    return _started(scans.writeStream.outputMode("append"), merge, checkpoint or _checkpoint(scans, counts.path), available_now)
