"""Watch a stream of failures and trip latches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.failure_log import FailureLog


def failure_state(
    failures: DataFrame, log: FailureLog, checkpoint: str, poll: str | None = "2 seconds"
) -> StreamingQuery:
    """Store streamed failures and keep ``log.latches()`` up to date.

    Per-key streaming state would send every failure of a scope, and the scope
    may be one global one, through a single task. Each micro-batch instead goes
    through the batch operator, which splits a scope by time. A replayed epoch
    replaces its own rows, so failures are counted once.
    """

    def run(df: DataFrame, epoch: int) -> None:
        log.absorb(df, batch=f"stream-{epoch}")

    writer = failures.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if poll is None else {"processingTime": poll}
    return writer.trigger(**trigger).start()
