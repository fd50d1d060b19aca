"""Running a streaming query over all input there is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter


def run_to_end(writer: DataStreamWriter, checkpoint: str, time_limit: float | None = None) -> None:
    """Process the available input in micro-batches, then stop.

    Started again with the same checkpoint, it takes up what has arrived since
    and repeats nothing. It runs as long as there is input; a caller who cannot
    wait gives ``time_limit`` in seconds, after which it is stopped and reported.
    """
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    if time_limit is None:
        query.awaitTermination()
    elif not query.awaitTermination(time_limit):
        query.stop()
        raise TimeoutError(f"streaming query still running after {time_limit} s")


def each_batch(
    stream: DataFrame,
    write: Callable[[DataFrame, str], None],
    checkpoint: str,
    time_limit: float | None = None,
) -> None:
    """Hand every micro-batch to ``write`` with a name of its own.

    A micro-batch is an ordinary frame: its joins are planned by AQE, which
    splits hot keys. A batch that is repeated after a failure has the same name,
    so ``write`` can replace what the first attempt left. The name holds the
    query's id, which lives in the checkpoint: a new checkpoint never replaces
    what an older one wrote.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write(batch, f"{query}-{batch_id}")

    run_to_end(stream.writeStream.foreachBatch(handle), checkpoint, time_limit)
