"""Starting, finishing and resuming streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

RESTARTS = 3
RESTART_DELAY_S = 10.0


def file_writer(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Parquet files; each record counts once, also over restarts."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def print_writer(df: DataFrame, label: str | None = None, mode: str = "append") -> DataStreamWriter:
    """Console output; the label names the query."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", False)
    return writer.queryName(label) if label else writer


def batch_writer(
    df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append"
) -> DataStreamWriter:
    return (
        df.writeStream.outputMode(mode)
        .foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
    )


def run_available(writer: DataStreamWriter, timeout_s: float | None = None) -> StreamingQuery:
    """Process what is there now and stop. Without a limit it takes as long as it
    takes; reaching a limit raises."""
    query = writer.trigger(availableNow=True).start()
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"stream not finished after {timeout_s} s")
    return query


def _used_up(progress: StreamingQueryProgress, first_batch: int, drain: bool) -> bool:
    """Whether a micro-batch of this run found nothing new in any source and, if
    asked, left no state behind. The first one may repeat a batch of an earlier
    run, so it does not count."""
    if progress.batchId <= first_batch or progress.numInputRows:
        return False
    if any(source.startOffset != source.endOffset for source in progress.sources):
        return False
    return not drain or not any(op.numRowsTotal for op in progress.stateOperators)


def run_until_used_up(
    writer: DataStreamWriter, drain: bool = False, timeout_s: float | None = None
) -> StreamingQuery:
    """Process what is there and stop, for queries on processing time, which never
    end by themselves. They have ended when a micro-batch begins and ends at the
    sources' last offsets; with ``drain`` also when timers have closed all that
    is held in state. Reaching a limit raises."""
    query = writer.trigger(processingTime="0 seconds").start()
    started = time.monotonic()
    first_batch: int | None = None
    try:
        while query.isActive:
            progress = query.lastProgress
            if progress is not None:
                if first_batch is None:
                    first_batch = progress.batchId
                if _used_up(progress, first_batch, drain):
                    break
            if timeout_s is not None and time.monotonic() - started > timeout_s:
                raise TimeoutError(f"stream not finished after {timeout_s} s")
            time.sleep(0.1)
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()
    return query


def run_until_idle(
    writer: DataStreamWriter, idle_s: float = 0.0, timeout_s: float | None = None
) -> StreamingQuery:
    """The earlier name of ``run_until_used_up``. No time decides any more: an
    ``idle_s`` above zero, once the wait for timers, stands for ``drain``."""
    return run_until_used_up(writer, drain=idle_s > 0, timeout_s=timeout_s)


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function whose repeat after a failure replaces the
    micro-batch's rows instead of adding them again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def run_resumable(
    start: Callable[[], StreamingQuery],
    restarts: int = RESTARTS,
    delay_s: float = RESTART_DELAY_S,
) -> StreamingQuery:
    """Await a query and start it again after a failure, up to ``restarts``
    times. ``start`` must use the same checkpoint folder every time, from which
    the new run goes on."""
    for attempt in range(restarts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException:
            if attempt == restarts:
                raise
            time.sleep(delay_s)
    raise AssertionError("unreachable")


def last_updates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row per key of what update mode wrote with ``write_batch``."""
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    last = F.max_by(F.struct(*values), "batch_id").alias("last")
    return rows.groupBy(*keys).agg(last).select(*keys, "last.*")


def write_result(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for complete mode: the latest result replaces
    the one before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write
