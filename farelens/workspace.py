"""Where staged files, stream checkpoints and result tables go."""

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: A query deletes its shuffle files when it is done. Else they stay on the executors until the driver
#: collects its garbage, which plans that are few seldom make it do. For what is planned anew each time:
#: a result that is computed twice misses its files.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Fewer partitions than this are written side by side by a task, each row as it comes; at this number
#: the rows that are left are sorted, and written one partition after the other.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory under the folder named by ``spark.checkpoint.dir``.

    That folder is shared, so a stage can be recomputed on any executor. Only a session whose
    one machine is this one (``local`` or ``local[n]``) falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="farelens-")
    path = f"{base.rstrip('/')}/farelens/{label}-{uuid.uuid4().hex}"
    for paths in _open:
        paths.append(path)
    return path


_open: list[list[str]] = []


@contextmanager
def session_settings(spark: SparkSession, wanted: dict[str, str]):
    """Settings of the session within the block. A query that another thread plans meanwhile sees
    them too."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete, at the end, the scratch directories made within: results that read them must
    have been computed by then. One thread at a time."""
    paths: list[str] = []
    _open.append(paths)
    try:
        yield
    finally:
        _open.remove(paths)
        for path in paths:
            delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return []
    return [status.getPath().getName() for status in store.listStatus(target)]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files in a folder; 0 if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getContentSummary(target).getLength() if store.exists(target) else 0


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small ASCII file that appears whole: written beside its place and renamed."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = target.getParent()
    beside = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{uuid.uuid4().hex}.part")
    stream = store.create(beside, True)
    try:
        stream.writeBytes(text)
    finally:
        stream.close()
    if not store.rename(beside, target):
        store.delete(beside, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return None
    stream = store.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def stored(df: DataFrame) -> DataFrame:
    """Write a small derived table to the shared folder and read it back.

    Its lineage ends there, and Spark knows its size when it plans a join with it: whether
    to broadcast is then decided before the large side has been shuffled.
    """
    path = scratch_dir(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
