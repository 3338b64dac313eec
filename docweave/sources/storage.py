"""Tables in the shared folder: snapshots, staged batches, indexes, cut lineages."""

from __future__ import annotations

import os
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from docweave.errors import ConfigError


# Fixed value: Spark's setting by which the shuffle files of a run go when it has ended; without it they stay until
# the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
_tidied: dict[int, list] = {}  # sessions inside `tidy`: how often, and the setting before
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go as soon as it has run."""
    at = spark._jsparkSession.hashCode()
    with _lock:
        held = _tidied.setdefault(at, [0, spark.conf.get(CLEANUP, "false")])
        held[0] += 1
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(CLEANUP, _tidied.pop(at)[1])


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """`tidy`, for work that hands out no frame: what `stored` makes inside is packed tighter, and removed at the end."""
    made: list[str] = []
    token = _made.set(made)
    try:
        with tidy(spark):
            yield
    finally:
        _made.reset(token)
        for location in made:
            remove(spark, location)


def storage_root(spark: SparkSession) -> str:
    """Shared folder for everything written here: `spark.checkpoint.dir`, else, in local mode, the
    SQL warehouse. On a cluster the warehouse may be one machine's disk, so the setting is needed."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ConfigError("set spark.checkpoint.dir to a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/docweave"


def new_location(spark: SparkSession, label: str) -> str:
    return f"{storage_root(spark)}/{label}/{uuid.uuid4().hex}"


def stored(rows: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: its lineage ends there, so
    a lost executor costs no recomputation."""
    location, made = new_location(rows.sparkSession, label), _made.get()
    writer = rows.write
    if made is not None:
        made.append(location)
        writer = writer.option("compression", "zstd")
    writer.parquet(location, partitionBy=partition_by)
    return rows.sparkSession.read.parquet(location)


# Small files of the shared folder, through the file system that Spark itself uses for the path.

def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    at, files = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(at)) if files.exists(at) else []


def seconds_since_change(spark: SparkSession, path: str) -> float:
    at, files = _file_system(spark, path)
    return time.time() - files.getFileStatus(at).getModificationTime() / 1000


def bytes_in(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of all files in some folders."""
    total = 0
    for path in paths:
        at, files = _file_system(spark, path)
        total += files.getContentSummary(at).getLength() if files.exists(at) else 0
    return total


def read_small(spark: SparkSession, path: str) -> str:
    at, files = _file_system(spark, path)
    stream = files.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file that nobody else has created; False if somebody has. It appears whole or not
    at all: it is written under another name and then linked (local) or renamed without overwriting."""
    draft = f"{path}.{uuid.uuid4().hex}.draft"
    at, files = _file_system(spark, draft)
    stream = files.create(at, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if files.getUri().getScheme() == "file":
        plain = at.toUri().getPath()
        try:
            os.link(plain, plain.removesuffix(draft.removeprefix(path)))
            return True
        except FileExistsError:
            return False
        finally:
            files.delete(at, False)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not files.exists(target) and files.rename(at, target):
        return True
    files.delete(at, False)
    return False


def remove(spark: SparkSession, path: str) -> None:
    at, files = _file_system(spark, path)
    files.delete(at, True)
