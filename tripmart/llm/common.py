"""What the corpus operators share: words, stored intermediate tables, files of tasks."""

from __future__ import annotations

import logging
import posixpath
import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.functions.columns import named
from tripmart.sources.scratch import scratch_folder

# Fixed value: a word of most contracts is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)

def n_words(text: Column) -> Column:
    """Number of words, zero without a text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


BATCH_BYTES = 16 * 1024 * 1024


def as_rows(df: DataFrame) -> Column:
    """All columns of a frame as one, ``row``, so that none clashes with those to come."""
    return F.struct(*(named(c) for c in df.columns)).alias("row")


def stored(df: DataFrame, label: str) -> DataFrame:
    """A frame written to shared scratch storage and read again.

    Cuts the lineage: what is read later survives lost executors, and its size is known
    to the planner before it chooses a join.
    """
    path = scratch_folder(df.sparkSession, label)
    _made.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# The folders of stored frames, by the scope that is open.
_made: ContextVar[list[str]] = ContextVar("made", default=[])  # noqa: B039


@contextmanager
def scope() -> Iterator[list[str]]:
    """Collects the folders of the frames that are stored within, oldest first. What is not
    discarded by then belongs to the scope around it afterwards."""
    outer, mine = _made.get(), []
    token = _made.set(mine)
    try:
        yield mine
    finally:
        _made.reset(token)
        outer.extend(mine)


def discard(folders: list[str]) -> None:
    """Delete folders of stored frames that nothing reads any more, and forget them."""
    for folder in list(folders):
        system, path = file_system(folder)
        try:
            system.delete_dir(path)
        except OSError as error:  # it takes room, and nothing else
            log.warning("%s stays: %s", folder, error)
    folders.clear()


def rows_in_arrow(
    function: Callable[[Iterator[dict]], Iterator[tuple]], schema: pa.Schema, rows: int = 2000
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function from one over dictionaries of a task's rows.

    The rows pass one Arrow batch at a time, in either direction. A batch that goes out is
    full at ``rows`` rows, or at ``BATCH_BYTES`` of texts, however long a single one is.
    """

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        incoming = (row for batch in found for row in batch_rows(batch))
        pending: list[tuple] = []
        size = 0
        for row in function(incoming):
            pending.append(row)
            size += sum(len(value) for value in row if isinstance(value, str | bytes))
            if len(pending) >= rows or size >= BATCH_BYTES:
                yield as_batch(pending, schema)
                pending, size = [], 0
        if pending:
            yield as_batch(pending, schema)

    return batches


def batch_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, made into Python values a slice at a time."""
    for start in range(0, batch.num_rows, 256):
        yield from batch.slice(start, 256).to_pylist()


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


# Rows of texts per task, beyond which the input sets the number of partitions.
TASK_ROWS = 100_000


def sized_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle of whole texts: as many as the session has, and more where a
    task would get more than ``TASK_ROWS``. Counting the rows of stored files reads no column.
    """
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // TASK_ROWS))


def one_each(df: DataFrame, rows: int) -> DataFrame:
    """A small frame of ``rows`` rows, such as a list of files, with a partition per row."""
    return df.coalesce(1).repartition(max(1, rows))


# -- Files that tasks write and read on shared storage ------------------------------


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or a local path, and the path within it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


class TaskFile:
    """A file of one task. It gets its name when it is complete, so that a retried or
    repeated task replaces it as a whole and readers never see a part of one. A task that
    writes several numbers them."""

    def __init__(self, folder: str, suffix: str, nth: int = 0) -> None:
        task = TaskContext.get()
        part, attempt = (task.partitionId(), task.taskAttemptId()) if task else (0, 0)
        self.system, root = file_system(folder)
        self.system.create_dir(root, recursive=True)
        name = f"part-{part:06d}-{nth:05d}{suffix}"
        self.part, self.nth = part, nth
        self.uri = f"{folder.rstrip('/')}/{name}"
        self._final = posixpath.join(root, name)
        self._open = posixpath.join(root, f".{name}.{attempt}")
        self.stream = self.system.open_output_stream(self._open, compression=None)

    def commit(self) -> str:
        self.stream.close()
        self.system.move(self._open, self._final)
        return self.uri


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder for files of tasks, below the shared scratch folder."""
    return scratch_folder(spark, label)
