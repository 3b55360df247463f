"""Streams into tables: run over what is there, or keep running and be asked."""

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from functools import partial
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from farelens.streaming import manifests
from farelens.workspace import RELEASE, folders, session_settings, size

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_starting = Lock()


@contextmanager
def stream_settings(
    spark: SparkSession, state_partitions: int | None = None, reports: int | None = None
):
    """Session settings that a stream copies when it starts.

    RocksDB keeps state on disk, so it may outgrow executor memory, and uploads only the
    changes of a batch to the checkpoint. The partition count is fixed by the first start
    of a checkpoint. Settings are the session's: one stream starts at a time, and a query that
    another thread plans meanwhile sees them too.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        RELEASE: "true",
    }
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    if reports:
        wanted["spark.sql.streaming.numRecentProgressUpdates"] = str(reports)
    with _starting, session_settings(spark, wanted):
        yield


def run_to_memory(
    result: DataFrame,
    name: str,
    checkpoint: str | None = None,
    state_partitions: int | None = None,
) -> DataFrame:
    """Complete results in an in-memory table called ``name``.

    The whole result sits on the driver: only for results of a bounded size.
    """
    spark = result.sparkSession
    writer = result.writeStream.format("memory").queryName(name).outputMode("complete")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    with stream_settings(spark, state_partitions):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name)


class StreamTable:
    """A table that a stream maintains under ``path``, version by version.

    Every micro-batch writes its changes into a folder of its own, so a batch repeated after a
    failure replaces its own rows, and counts from the moment its manifest is there. ``fold``
    makes the table's rows of all changes, told apart by ``batch_id``. Every ``compact_every``
    batches the folded rows become a snapshot, if the changes since the last one are as large as it:
    so all snapshots together write no more than twice what the batches have written, however long
    the stream. What a snapshot covers is deleted once no reader holds it: see
    :mod:`farelens.streaming.manifests`. With ``order``, snapshots are sorted by these columns, so that
    a reader of some of their values skips the rest.

    The checkpoint is part of the table: ``path`` holds both, so start again with the same path to
    take up new files. A table that has lost its checkpoint is refused, as a stream that starts
    anew would number its batches below those that are there.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        fold: Callable[[DataFrame], DataFrame],
        compact_every: int = 10,
        order: Sequence[str] = (),
    ) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.fold, self.compact_every, self.order = fold, compact_every, order

    @property
    def checkpoint(self) -> str:
        return f"{self.path}/_checkpoint"

    def check(self) -> None:
        lost = not folders(self.spark, self.checkpoint)
        if lost and manifests.newest(self.spark, self.path) is not None:
            raise ValueError(f"{self.path} holds batches of a stream whose checkpoint is gone")

    def write(self, changes: DataFrame, batch_id: int) -> None:
        now = manifests.newest(self.spark, self.path) or manifests.Manifest(-1, None, ())
        if batch_id <= now.version:
            # Repeated after its commit. The rows are there, but state is only committed for a
            # batch that has been computed.
            changes.write.format("noop").mode("overwrite").save()
            return
        self._write(changes, f"changes/batch_id={batch_id}")
        after = manifests.Manifest(batch_id, now.snapshot, (*now.batches, batch_id))
        whole = (batch_id + 1) % self.compact_every == 0 and self._grown(after)
        if whole:
            # In the session of the batch, which releases its shuffles; the caller's may not.
            rows = self.rows(after, changes.sparkSession)
            if self.order:
                rows = rows.repartitionByRange(*self.order).sortWithinPartitions(*self.order)
            self._write(rows, f"snapshots/upto={batch_id}")
            after = manifests.Manifest(batch_id, batch_id, ())
        manifests.commit(self.spark, self.path, after)
        if whole:
            manifests.vacuum(self.spark, self.path)

    def _write(self, rows: DataFrame, folder: str) -> None:
        """Files are as even as the shuffle that made the rows; one more would move the table twice."""
        rows.write.mode("overwrite").parquet(f"{self.path}/{folder}", compression="zstd")

    def _grown(self, manifest: manifests.Manifest) -> bool:
        """Whether the changes since the snapshot are as large as it is."""
        if manifest.snapshot is None:
            return True
        snapshot = size(self.spark, f"{self.path}/snapshots/upto={manifest.snapshot}")
        changes = (size(self.spark, f"{self.path}/changes/batch_id={n}") for n in manifest.batches)
        return sum(changes) >= snapshot

    def rows(
        self, manifest: manifests.Manifest | None, spark: SparkSession | None = None
    ) -> DataFrame:
        """What the table holds in a version."""
        spark = spark or self.spark
        changes = spark.createDataFrame([], T.StructType([*self.schema.fields, _BATCH]))
        if manifest and manifest.folders():
            number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch_id|upto)=(\d+)/", 1)
            paths = [f"{self.path}/{folder}" for folder in manifest.folders()]
            files = spark.read.schema(self.schema).parquet(*paths)
            changes = files.select("*", number.cast("long").alias("batch_id"))
        return self.fold(changes)

    def read(self, spark: SparkSession | None = None) -> DataFrame:
        """What the table holds now. While the stream runs, use :meth:`pinned`: a compaction may
        delete what this reads before it is computed."""
        return self.rows(manifests.newest(self.spark, self.path), spark)

    @contextmanager
    def pinned(self):
        """The newest version as a table that stays readable, and the same, within the block."""
        with manifests.pinned(self.spark, self.path) as manifest:
            yield self.rows(manifest)


class RunningTable:
    """A stream that maintains a table: ask for its progress, read it while it runs, stop it."""

    def __init__(self, query: StreamingQuery, table: StreamTable) -> None:
        self.query, self.table = query, table

    @property
    def name(self) -> str | None:
        return self.query.name

    @property
    def is_active(self) -> bool:
        return self.query.isActive

    def progress(self) -> list[dict]:
        """Per batch that Spark still reports (the last 100 unless
        ``spark.sql.streaming.numRecentProgressUpdates`` says otherwise): its number, rows taken,
        milliseconds, rows of state kept, and rows left out as later than the watermark."""
        return [batch_progress(p) for p in self.query.recentProgress]

    def catch_up(self) -> None:
        """Wait until everything that is there now has been taken."""
        self.query.processAllAvailable()

    def wait(self, seconds: float | None = None) -> bool:
        """Wait for the end of the stream, an error included; whether it ended."""
        if seconds is None:
            self.query.awaitTermination()
            return True
        return self.query.awaitTermination(seconds)

    def stop(self) -> None:
        """End the stream. A batch that is cut off is repeated by the next start."""
        self.query.stop()

    def pinned(self):
        return self.table.pinned()


def batch_progress(report) -> dict:
    return {
        "batch": report.batchId,
        "rows": report.numInputRows,
        "milliseconds": report.batchDuration,
        "state_rows": sum(s.numRowsTotal for s in report.stateOperators),
        "late_rows": sum(s.numRowsDroppedByWatermark for s in report.stateOperators),
    }


def start_table(
    result: DataFrame,
    path: str,
    fold: Callable[[DataFrame], DataFrame],
    change: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    name: str | None = None,
    state_partitions: int | None = None,
    compact_every: int = 10,
    every: str | None = None,
    against: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
    order: Sequence[str] = (),
    reports: int | None = None,
) -> RunningTable:
    """Start a stream in update mode whose batches, by way of ``change``, go into a table.

    What goes in may depend on what the table holds before the batch: ``against`` makes it of what
    ``change`` gives and that. ``order`` is as in :class:`StreamTable`; ``reports`` is the number of
    batches whose progress Spark keeps.

    ``every`` is the time between batches, such as "10 seconds", of a stream that keeps running;
    without it the stream takes what is there now, in several batches, and ends.
    """
    spark = result.sparkSession
    empty = spark.createDataFrame([], result.schema)
    table = StreamTable(spark, path, change(empty).schema, fold, compact_every, order)
    table.check()

    def take(batch: DataFrame, batch_id: int) -> None:
        changes = change(batch)
        if against:
            changes = against(changes, table.read(batch.sparkSession))
        table.write(changes, batch_id)

    writer = result.writeStream.outputMode("update").option("checkpointLocation", table.checkpoint)
    writer = writer.foreachBatch(take)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with stream_settings(spark, state_partitions, reports):
        return RunningTable(writer.start(), table)


def run_table(result: DataFrame, path: str, fold, **options) -> DataFrame:
    """Take what is there now; the table after that."""
    running = start_table(result, path, fold, **options)
    running.wait()
    return running.table.read()


def run_to_table(result: DataFrame, path: str, keys: Sequence[str], **options) -> DataFrame:
    """Changed rows of every micro-batch, and of each key the newest one. Update mode writes what a
    batch changed, not the whole result again. ``options`` as in :func:`start_table`."""
    return run_table(result, path, partial(newest_rows, keys=keys), **options)


_BATCH = T.StructField("batch_id", T.LongType())


def newest_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of the rows written for each key, the one of the last micro-batch."""
    values = [c for c in changes.columns if c not in (*keys, "batch_id")]
    if not values:
        return changes.select(*keys).distinct()
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def summed_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums of what the batches added to each key. Types stay those of the changes."""
    added = [f for f in changes.schema.fields if f.name not in (*keys, "batch_id")]
    sums = [F.sum(f.name).cast(f.dataType).alias(f.name) for f in added]
    return changes.groupBy(*keys).agg(*sums)


# --- append -----------------------------------------------------------------------------


def append_to_files(
    result: DataFrame,
    path: str,
    name: str | None = None,
    state_partitions: int | None = None,
) -> list[dict]:
    """Append mode into Spark's file sink: a row is written once, when the watermark says that it
    is final. The sink's log names the files of every batch, and ``spark.read.parquet`` reads only
    those, so a batch repeated after a failure leaves no second copy.

    Takes what is there now and returns the progress of each batch, as in
    :meth:`RunningTable.progress`; ``late_rows`` are those that came behind the watermark.
    """
    spark = result.sparkSession
    writer = result.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", f"{path}/_checkpoint").trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    with stream_settings(spark, state_partitions, reports=100_000):
        query = writer.start()
    query.awaitTermination()
    return [batch_progress(p) for p in query.recentProgress]
