"""Run the sync as snapshots arrive, and stop it while the latch is on."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.collation import BINARY, key_column
from tidemark.functions.fingerprint import stream_id
from tidemark.model import Destination, SyncJob, check_destinations
from tidemark.operators.latest import newest_first
from tidemark.plans.sync import Workspace, blank_metrics, run_job
from tidemark.session import remove_path

BatchFunction = Callable[[DataFrame, int], None]

COUNTS = ("changes", "inserted", "updated", "errors")


class DeliveryPaused(RuntimeError):
    """The failure latch is on; clear it to resume."""


class DeliveryFailed(RuntimeError):
    """An epoch did not reach every destination; it is tried again when the query restarts."""


def guarded(batch_fn: BatchFunction, latched: Callable[[], bool]) -> BatchFunction:
    """Raise before anything is written while ``latched``; the checkpoint then stays put."""

    def run(df: DataFrame, epoch: int) -> None:
        if latched():
            raise DeliveryPaused("delivery is paused by the failure latch")
        batch_fn(df, epoch)

    return run


def newest_rows(df: DataFrame, keys: Sequence[str], order: str, collation: str = BINARY) -> DataFrame:
    """Of each key the rows with the newest ``order``, without it.

    They stand for all snapshots of a micro-batch: deletes are never sent, so for a target that
    keeps one version a part is as good as a whole. A key that repeats within one ``order``
    stays repeated, and the check of keys finds it. A map task sends the newest rows it has of a key.
    """
    line = Window.partitionBy(*[key_column(df, k, collation) for k in keys]).orderBy(*newest_first(f"`{order}`"))
    return df.withColumn("_rank", F.rank().over(line)).where("_rank = 1").drop("_rank", order)


def sync_batches(
    workspace: Workspace, job: SyncJob, destinations: Sequence[Destination], order: str, scope: str
) -> BatchFunction:
    """foreachBatch body: the snapshots in the micro-batch are synced in one pass, then the epoch ends well or raises.

    History destinations get every version that differs from the one before, others the
    newest. ``order`` itself is not delivered. A delivery that
    failed or was left out because the latch tripped raises after all is recorded: the
    checkpoint stays, and the replay sends only what the state does not know.
    """
    versions = any(d.mode == "history" for d in destinations)
    name = stream_id(job.name, "epoch", [])

    def run(df: DataFrame, epoch: int) -> None:
        cycle, run_name = f"epoch-{epoch}", f"{name}-{epoch}"
        before = workspace.metrics_of(run_name)
        marks = f"{workspace.root}/epochs/{run_name}"
        metrics: list[dict] = []
        try:
            if versions:
                metrics = run_job(workspace, job, destinations, cycle, df, scope, order, marks)
            else:
                newest = newest_rows(df, job.keys, order, job.key_collation)
                metrics = run_job(workspace, job, destinations, cycle, newest, scope)
            complete = {m["destination"] for m in metrics if not m["errors"]} == {d.id for d in destinations}
        except Exception as error:
            complete = False
            workspace.failures.record(scope, workspace.clock(), job.name, None, str(error))
            metrics.append(blank_metrics(cycle, job.name, errors=1))
        workspace.store_metrics(summed(before, metrics), run_name)
        if not complete:
            failed = [m["destination"] for m in metrics if m["errors"]]
            raise DeliveryFailed(f"epoch {epoch} of job {job.name!r} did not reach all destinations; failed: {failed}")
        remove_path(workspace.spark, marks)

    return run


def summed(before: list[dict], now: list[dict]) -> list[dict]:
    """Metrics of an epoch over its tries: rows that arrived add up, errors are those of the last try."""
    total: dict = {}
    for m in [{**m, "errors": 0} for m in before if m["destination"] is not None] + now:
        held = total.setdefault(m["destination"], {**m, **dict.fromkeys(COUNTS, 0), "rows_read": 0})
        held["rows_read"] = max(held["rows_read"], m["rows_read"])
        for count in COUNTS if not m["errors"] else ("errors",):
            held[count] += m[count]
    return list(total.values())


def stream_sync(
    snapshots: DataFrame,
    workspace: Workspace,
    job: SyncJob,
    destinations: Sequence[Destination],
    order: str,
    checkpoint: str,
    poll: str | None = "2 seconds",
    scope: str = "global",
) -> StreamingQuery:
    """Sync a stream of snapshot rows. ``poll=None`` handles what is there and stops."""
    check_destinations(destinations)
    body = guarded(
        sync_batches(workspace, job, destinations, order, scope),
        lambda: workspace.failures.is_latched(scope),
    )
    writer = snapshots.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if poll is None else {"processingTime": poll}
    return writer.trigger(**trigger).start()
