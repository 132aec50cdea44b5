"""Streaming device jobs: archive of the enriched stream and windowed totals."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabularium.operators import usage
from tabularium.sources.telemetry import ARCHIVE_KEYS, with_archive_parts

WATERMARK = "30 seconds"


def stream_minute_totals(enriched: DataFrame, window: str = "1 minute") -> DataFrame:
    """All metrics of a stream in one stateful aggregation; late rows end at the watermark."""
    return usage.fanout_totals(enriched, window=window, watermark=WATERMARK)


def _started(writer, checkpoint: str, continuous: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if not continuous:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def write_stream_archive(
    stream: DataFrame, root: str, checkpoint: str, ts: str = "timestamp", continuous: bool = False
) -> StreamingQuery:
    """Append to parquet partitioned by year/month/day/hour; every query has its own checkpoint."""
    writer = (
        with_archive_parts(stream, ts)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*ARCHIVE_KEYS)
        .option("path", root)
    )
    return _started(writer, checkpoint, continuous)


def write_stream_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    continuous: bool = False,
) -> StreamingQuery:
    """Hand every micro-batch to ``write(df, batch_id)``."""
    writer = stream.writeStream.outputMode("append").foreachBatch(write)
    return _started(writer, checkpoint, continuous)


def batch_folder_writer(root: str) -> Callable[[DataFrame, int], None]:
    """Each micro-batch overwrites its own folder, so a replayed batch leaves no duplicates."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return write


def jdbc_batch_writer(
    write_table: Callable[[DataFrame], None], remove_batch: Callable[[int], None]
) -> Callable[[DataFrame, int], None]:
    """Appends micro-batches to a table that commits partition by partition.

    ``remove_batch(batch_id)`` deletes the rows of a batch, then ``write_table(df)`` appends them
    with their ``batch_id``. A batch that failed half way is replayed by the stream, and what it had left goes first,
    so the table ends up with every row once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        remove_batch(batch_id)
        write_table(batch.withColumn("batch_id", F.lit(batch_id)))

    return write


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait for every query; the first failure stops the others and is raised."""
    try:
        while active := [q for q in queries if q.isActive or q.exception()]:
            for query in active:
                query.awaitTermination(1)
    except Exception:
        for query in queries:
            if query.isActive:
                query.stop()
        raise


def replay_arrivals(
    arrivals: Iterable[DataFrame], folder: str, start: Callable[[], StreamingQuery]
) -> list[int]:
    """Add rows to a watched folder one arrival after another; the stream goes on from its checkpoint each time.

    ``start`` begins a run that ends when all files are read. The result is, per arrival, how many rows
    (partial sums of rows that agree in all keys) came behind the watermark and were dropped.
    """
    dropped = []
    for rows in arrivals:
        rows.write.mode("append").parquet(folder)
        query = start()
        query.awaitTermination()
        states = [state for progress in query.recentProgress for state in progress.stateOperators]
        dropped.append(sum(state.numRowsDroppedByWatermark for state in states))
    return dropped


def run_device_job(
    devices: DataFrame,
    users: DataFrame,
    archive_root: str,
    totals_root: str,
    checkpoints: str,
) -> None:
    """Archive the enriched stream and append minute totals, side by side, to completion."""
    enriched = usage.enrich(devices, users)
    await_all(
        [
            write_stream_archive(enriched, archive_root, f"{checkpoints}/archive"),
            write_stream_batches(
                stream_minute_totals(enriched),
                batch_folder_writer(totals_root),
                f"{checkpoints}/totals",
            ),
        ],
    )
