"""Helpers the operators share: task functions over Arrow, word numbers, stored tables."""

import ctypes
import gc
import os
import re
import shutil
import sys
import tempfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import farelens
from farelens.workspace import scratch_dir


#: Spark's bound on the bytes of an Arrow batch.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a local session, once per application. On a
    cluster it is installed or named by ``--py-files``, as for any application."""
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        return
    if any("farelens-package" in name for name in context._python_includes):
        return
    folder = os.path.dirname(farelens.__file__)
    base = os.path.join(tempfile.mkdtemp(), "farelens-package")
    context.addPyFile(
        shutil.make_archive(base, "zip", os.path.dirname(folder), os.path.basename(folder))
    )


def release_memory() -> None:
    """Hand free memory back to the system: a Python worker lives on for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with suppress(OSError, AttributeError):  # a C library without this call keeps it
            ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow``. Rows may hold long texts, so unless the session says otherwise batches are
    bounded by bytes as well as by rows."""
    spark = df.sparkSession
    ship_package(spark)
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, 8 << 20)

    def run(batches):
        yield from function(batches)
        release_memory()

    return df.mapInArrow(run, schema)


def group_arrow(df: DataFrame, key: str, function: Callable, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.groupBy(key).applyInArrow(function, schema)


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that other columns of the caller never clash."""
    types = {"doc_id": "long"}
    return docs.select(
        *(F.col(c).cast(types.get(c, "string")).alias(c) for c in columns or ("doc_id", "text"))
    )


def stored_table(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends, lost executors cost nothing."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cogroup_arrow(
    left: DataFrame, right: DataFrame, key: str, function: Callable, schema: str
) -> DataFrame:
    ship_package(left.sparkSession)
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(function, schema)


def bucketed_table(df: DataFrame, key: str, label: str) -> DataFrame:
    """Like :func:`stored_table`, in buckets of ``key``: joins and groups by it need no shuffle."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    name = path.rpartition("/")[2].replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.option("path", path).bucketBy(buckets, key).saveAsTable(name)
    return spark.table(name)


def table_of(columns: dict, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def batch_of(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def held_out(doc_id, modulus: int):
    """Whether the checksum of the id as text leaves the remainder 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == 2, F.lit(False))


class Words(dict):
    """Numbers words in the order they are first met. A cache, not a count of the corpus."""

    def __init__(self) -> None:
        super().__init__()
        self.order: list = []

    def __missing__(self, word) -> int:
        number = self[word] = len(self.order)
        self.order.append(word)
        return number

    def numbers(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class WordCache:
    """Values of words that recur: each is computed once while it stays in the cache.

    The cache is emptied between texts when it has ``most`` words or so many million bytes, so
    memory is bounded by the longest text and not by the vocabulary of a partition.
    """

    def __init__(self, value: Callable[[bytes], object], most: int = 1 << 20) -> None:
        self.value, self.most = value, most
        self.clear()

    def clear(self) -> None:
        self.words, self.values, self.size = Words(), [], 0

    def of(self, words: list[bytes]) -> tuple[np.ndarray, list]:
        """Numbers of the words, and the list that holds a value for each number."""
        if len(self.values) > self.most or self.size > 64 * self.most:
            self.clear()
        numbers = self.words.numbers(words)
        for word in self.words.order[len(self.values) :]:
            self.values.append(self.value(word))
            self.size += len(word)
        return numbers, self.values


def lower_words(text: str | None) -> list[bytes]:
    """Words between the six ASCII white-space characters, A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "replace").lower().split()


def text_slices(
    batches: Iterable[pa.RecordBatch], most_bytes: int = 32 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about so many bytes: rows may be long."""
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            size, end = 0, start
            for end in range(start, batch.num_rows):
                value = batch.column("text")[end]
                size += 0 if not value.is_valid else len(value.as_buffer())
                if size > most_bytes:
                    break
            yield batch.slice(start, end + 1 - start)
            start = end + 1


def dump(array: np.ndarray, ascending: bool = False) -> bytes:
    """An array as compressed bytes; ascending ones as differences, bytes by significance."""
    raw = np.ascontiguousarray(np.diff(array, prepend=array.dtype.type(0)) if ascending else array)
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes() if len(raw) else b""
    codec = pa.Codec("zstd", compression_level=5)
    return len(raw).to_bytes(8, "little") + codec.compress(planes, asbytes=True)


def load(data: bytes, kind: str, ascending: bool = False) -> np.ndarray:
    length, item = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not length:
        return np.empty(0, kind)
    planes = pa.Codec("zstd").decompress(data[8:], length * item, asbytes=True)
    grid = np.frombuffer(planes, np.uint8).reshape(item, length)
    values = np.ascontiguousarray(grid.T).reshape(-1).view(kind)
    return np.cumsum(values, dtype=kind) if ascending else values
