"""Starting, stopping and restarting streaming queries.

A query's identity is its application id: it names the query and its
checkpoint folder under the shared checkpoint root, so a restart resumes
where the last run stopped (committed offsets + state).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rivulet.session import checkpoint_root

# The failure message a stream may be restarted after.
RETRYABLE_MESSAGES = ("Retryable transient error",)


@dataclass(frozen=True)
class StreamRun:
    """One run of an application: everything it keeps -- progress, state, sinks
    -- lies below one folder, so that a reset leaves nothing behind to be mixed
    in.  ``number`` counts resets."""

    app_id: str
    number: int
    folder: str

    @property
    def checkpoint(self) -> str:
        """Progress and state of the run's query."""
        return self.folder if self.number == 0 else f"{self.folder}/checkpoint"

    def path(self, name: str) -> str:
        """The run's own folder for a sink or side output."""
        return f"{self.folder}/{name}" if self.number else f"{self.folder}-{name}"


def stream_run(spark: SparkSession, app_id: str, reset: bool = False) -> StreamRun:
    """The present run of an application, or with ``reset`` a new one.

    The run is recorded by its folder, made at once below the shared checkpoint
    root: a restart, on any driver, finds the newest run and reads and writes
    that one's folders only.  Old runs stay where they are."""
    base = f"{checkpoint_root(spark)}/streams/{app_id}"
    runs = spark._jvm.org.apache.hadoop.fs.Path(f"{base}-runs")
    fs = runs.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(runs)] if fs.exists(runs) else []
    newest = max((int(n) for n in names if n.isdigit()), default=0)
    if reset:
        newest += 1
        if not fs.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{base}-runs/{newest}")):
            raise RuntimeError(f"cannot record run {newest} of {app_id}")
    return StreamRun(app_id, newest, f"{base}-runs/{newest}" if newest else base)


def stream_checkpoint(spark: SparkSession, app_id: str, reset: bool = False) -> str:
    """Checkpoint folder of an application's present run.  ``reset`` starts a
    new run with empty state; sinks named by ``stream_run(...).path`` start
    empty with it, and a restart stays in the new run."""
    return stream_run(spark, app_id, reset).checkpoint


def start_stream(df: DataFrame, app_id: str, *, path: str | None = None, fmt: str = "parquet",
                 output_mode: str = "append", foreach_batch: Callable | None = None,
                 trigger: dict | None = None, checkpoint: str | None = None,
                 reset: bool = False, options: dict | None = None) -> StreamingQuery:
    """Start ``df`` as the streaming query of application ``app_id``.

    Sinks: ``foreach_batch`` (a function of ``(batch_df, batch_id)``; make it
    idempotent per batch id), ``fmt='memory'`` (tests; table named
    ``app_id``), or a file format written to ``path``.  The default trigger
    processes what is available and stops.
    """
    spark = df.sparkSession
    ckpt = checkpoint or stream_checkpoint(spark, app_id, reset)
    w = (df.writeStream.queryName(app_id).outputMode(output_mode)
         .option("checkpointLocation", ckpt)
         .trigger(**(trigger or {"availableNow": True})))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    if fmt == "memory":
        return w.format("memory").start()
    return w.format(fmt).start(path)


def run_stream(df: DataFrame, app_id: str, **kw) -> StreamingQuery:
    """Start and wait until the trigger is done (``availableNow``/``once``)."""
    q = start_stream(df, app_id, **kw)
    q.awaitTermination()
    return q


@dataclass
class RetryPolicy:
    """Which failures restart the query, and how often.

    A failure whose text contains one of ``retryable`` restarts the query
    from its checkpoint (nothing committed is lost or repeated by file
    sinks); any other failure stops the application.
    """
    retryable: tuple[str, ...] = RETRYABLE_MESSAGES
    max_restarts: int = 3
    backoff_seconds: float = 0.0
    restarts: int = field(default=0, init=False)

    def should_restart(self, err: BaseException) -> bool:
        text = str(err)
        return self.restarts < self.max_restarts and any(m in text for m in self.retryable)


def run_with_policy(start: Callable[[], StreamingQuery], policy: RetryPolicy | None = None
                    ) -> StreamingQuery:
    """Run a query; on a retryable failure start it again (same checkpoint).

    ``start`` must start the query with the same application id each time.
    """
    policy = policy or RetryPolicy()
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except StreamingQueryException as e:
            if not policy.should_restart(e):
                raise
            policy.restarts += 1
            if policy.backoff_seconds:
                time.sleep(policy.backoff_seconds)
