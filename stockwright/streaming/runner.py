"""Running a job as a stream: checkpointed progress, replay-safe writes, state kept per batch."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_per_key
from ..sources.sinks import append_batch, drop_versions, exists, read_version, versions, write_version

BatchJob = Callable[[DataFrame, int], None]


def run_stream(source: DataFrame, job: BatchJob, checkpoint: str, mode: str = "append", once: bool = True,
               interval: str | None = None) -> StreamingQuery:
    """Start a stream whose micro-batches go to job(rows, batch_id)."""
    w = source.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(job)
    if interval:
        w = w.trigger(processingTime=interval)
    elif once:
        w = w.trigger(availableNow=True)
    return w.start()


def append_stream(source: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Typed rows straight into a table of files."""
    w = source.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if once else w).start()


def changelog_sink(path: str, app: str) -> BatchJob:
    """Job that appends the rows of an update-mode stream as a changelog."""
    return lambda rows, batch_id: append_batch(rows, path, batch_id, app)


def changelog_table(log: DataFrame, keys: list[str]) -> DataFrame:
    """Newest row per key of such a changelog."""
    return latest_per_key(log, keys, ["batch_id"]).drop("app_id", "batch_id")


Emitted = DataFrame | dict[str, DataFrame] | None


def emit(emitted: Emitted, out: str | None, batch_id: int, app: str) -> None:
    """Append the output of a batch; several outputs go to folders of their names."""
    if emitted is None or out is None:
        return
    if isinstance(emitted, DataFrame):
        append_batch(emitted, out, batch_id, app)
        return
    for name, rows in emitted.items():
        append_batch(rows, f"{out}/{name}", batch_id, app)


def stateless(out: str, step: Callable[[DataFrame], Emitted], app: str = "app") -> BatchJob:
    """Job without state: the output rows of each batch are appended."""

    def job(rows: DataFrame, batch_id: int) -> None:
        rows.persist()
        try:
            emit(step(rows), out, batch_id, app)
        finally:
            rows.unpersist()

    return job


def stateful(path: str, schema: T.StructType, step: Callable[[DataFrame, DataFrame], tuple[DataFrame, Emitted]],
             out: str | None = None, app: str = "app") -> BatchJob:
    """Job with a small state table, such as a queue: (state, rows) -> (new state, output rows).

    The state is written as one version per batch and each batch starts from the version before
    it, so a batch that is run again gives the same state and output.
    """

    def job(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.persist()
        try:
            state, emitted = step(read_version(spark, path, schema, before=batch_id), rows)
            emit(emitted, out, batch_id, app)
            write_version(state, path, batch_id)
            drop_versions(spark, path)
        finally:
            rows.unpersist()

    return job


COMPACT_EVERY = 20


def read_keyed(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], before: int | None = None,
               log_before: int | None = None) -> DataFrame:
    """State of a keyed job: the newest base and, over it, the last change per key since.

    before limits base and log to what earlier batches wrote; log_before lets the log go further.
    """
    log_before = before if log_before is None else log_before
    known = [v for v in versions(spark, f"{path}/base") if before is None or v < before]
    start = known[-1] if known else None
    base = read_version(spark, f"{path}/base", schema, before)
    if not exists(spark, f"{path}/log"):
        return base
    log = spark.read.schema(T.StructType([*schema, T.StructField("app_id", T.StringType()), T.StructField("batch_id", T.LongType())]))
    changes = log.parquet(f"{path}/log")
    if start is not None:
        changes = changes.where(F.col("batch_id") > start)
    if log_before is not None:
        changes = changes.where(F.col("batch_id") < log_before)
    newest = latest_per_key(changes, keys, ["batch_id"], []).drop("app_id", "batch_id")
    return base.join(newest.select(*keys), keys, "left_anti").unionByName(newest)


Pick = Callable[[DataFrame, DataFrame], DataFrame]


def same_keys(keys: list[str], of: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Pick:
    """State rows whose key occurs in the batch; of(rows) brings the batch into the shape of the key."""
    return lambda state, rows: state.join(of(rows).select(*keys).distinct(), keys, "left_semi")


def keyed(path: str, schema: T.StructType, keys: list[str], pick: Pick,
          step: Callable[[DataFrame, DataFrame], tuple[DataFrame, Emitted]], opening: DataFrame | None = None,
          out: str | None = None, app: str = "app", retain: Callable[[DataFrame], DataFrame] = lambda s: s,
          compact_every: int = COMPACT_EVERY) -> BatchJob:
    """Job whose batches change few keys of a large state.

    step sees only the state rows that pick(state, rows) selects and returns their new rows. A
    batch writes these as a change log; every so many batches base and log are merged into a new
    base, keeping what retain keeps. So a batch scans the state once, semi-joined with its keys
    (broadcast by Spark while they are few), and neither shuffles nor rewrites it. A batch that is
    run again replaces its own changes. The opening state is the first base.
    """

    def job(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        rows.persist()
        try:
            if not versions(spark, f"{path}/base"):
                first = opening if opening is not None else spark.createDataFrame([], schema)
                write_version(first.select(*schema.names), f"{path}/base", -1)
            state = read_keyed(spark, path, schema, keys, before=batch_id)
            changed, emitted = step(pick(state, rows).select(*schema.names), rows)
            emit(emitted, out, batch_id, app)
            append_batch(changed.select(*schema.names), f"{path}/log", batch_id, app)
            if batch_id % compact_every == compact_every - 1:
                # From the base before this one, so that a repeated compaction does not read what it writes.
                merged = read_keyed(spark, path, schema, keys, before=batch_id, log_before=batch_id + 1)
                write_version(retain(merged), f"{path}/base", batch_id)
                drop_versions(spark, f"{path}/base")
        finally:
            rows.unpersist()

    return job


def each_day(job: Callable[..., DataFrame], days: DataFrame, done: DataFrame) -> list:
    """Dates of days (column day) that have not been processed yet, in order; the caller runs them.

    A list of dates is bounded by the calendar.
    """
    open_days = days.select("day").distinct().join(done.select("day").distinct(), "day", "left_anti").orderBy("day")
    return [job(r["day"]) for r in open_days.toLocalIterator()]
