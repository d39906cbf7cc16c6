"""Session settings, shared scratch space and shuffle sizing."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache
from pathlib import Path
from threading import Lock
from typing import TypeVar

from pyarrow import fs
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

T = TypeVar("T")

#: What a stream with state is started with, in any session.
STREAMS = {
    # State beyond the heap: streams remember every claim for as long as copies may arrive.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Sessions of a hot key are merged where its rows are read, ahead of the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Splits an oversized shuffle partition of a join (one key holding a large share of the rows).
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splits an oversized month when a REBALANCE precedes a partitioned write.
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles a method of more than 8000 bytes; fall back to smaller ones instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    **STREAMS,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

TARGET_PARTITION_BYTES = 128 * 1024 * 1024
#: What a byte of Parquet becomes in the memory of a task behind a shuffle, in round figures. AQE merges partitions up to
#: ``TASK_BYTES``, but never divides those of an aggregate or a window.
IN_MEMORY = 16
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Most bytes that a task reads of a table and of a shuffle. Rows of short strings take some forty times their Parquet
#: size in memory (16 times their size in a shuffle), and what a task sorts or hashes should stay there.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 * 1024 * 1024,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 * 1024 * 1024,
}
#: Bytes of Parquet whose rows share a partition of a stream's state.
STATE_BYTES = 32 * 1024 * 1024
#: Shuffles go when the query that made them ends. Else they stay until the driver collects its garbage, so that the disk
#: holds those of all steps of a job at once. A frame that is evaluated again makes its shuffles again.
SHORT_LIVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of tables that a job writes and reads again; a third smaller than the default's.
COMPRESSION = "zstd"


def get_spark(app_name: str = "claimwright", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the jobs are written for. ANSI stays at Spark's default."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="claimwright-")


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """Folder every executor can reach, private to this application.

    The cluster names the shared folder in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors are one machine, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = _local_scratch()
    return "/".join([root.rstrip("/"), "claimwright", spark.sparkContext.applicationId, *parts])


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Writes tables to a folder of the run in the shared one and reads them back; removes them at the end."""
    root = shared_dir(spark, "staging", uuid.uuid4().hex)

    def stage(df: DataFrame, label: str) -> DataFrame:
        path = f"{root}/{label}"
        df.write.parquet(path, compression=COMPRESSION)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield stage
    finally:
        remove(root)


def remove(path: str) -> None:
    """Delete a folder of this library's own, if it is there."""
    target, at = fs.FileSystem.from_uri(path)
    if target.get_file_info(at).type == fs.FileType.Directory:
        target.delete_dir(at)


_shipped: set[str] = set()
_shipping = Lock()


def ship(spark: SparkSession) -> None:
    """Hand this library to the Python workers of the application, once, by way of the shared folder, so that
    tasks can import it wherever they run."""
    application = spark.sparkContext.applicationId
    with _shipping:
        if application in _shipped:
            return
        package, packed = Path(__file__).resolve().parent, io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, f"{package.name}/{file.relative_to(package)}")
        at = shared_dir(spark, "code", uuid.uuid4().hex)
        target, path = fs.FileSystem.from_uri(at)
        target.create_dir(path, recursive=True)
        with target.open_output_stream(f"{path}/{package.name}.zip") as out:
            out.write(packed.getvalue())
        spark.sparkContext.addPyFile(f"{at}/{package.name}.zip")
        _shipped.add(application)


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of the files under ``paths``, from the listing alone (no content is read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def small_tasks(spark: SparkSession, size: int = 0) -> None:
    """Lower the bytes that one task of this session reads to ``TASK_BYTES``; smaller settings stay. Shuffles become ``SHORT_LIVED``.

    ``size``: bytes of the input, where known. Shuffles then start with partitions enough for it, whatever number the
    session names, so that a task's share does not grow with the input; a number that is larger stays.
    """
    spark.conf.set(SHORT_LIVED, "true")
    for key, most in TASK_BYTES.items():
        number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
        if int(number) << 10 * " kmgtp".index(unit or " ") > most:
            spark.conf.set(key, str(most))
    wanted = size * IN_MEMORY // TARGET_PARTITION_BYTES
    if wanted > _partitions(spark):
        spark.conf.set(_PARTITIONS, str(wanted))


def _partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle starts with."""
    return int(spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def shuffles_sized_for(spark: SparkSession, size: int) -> Iterator[int]:
    """Start shuffles with enough partitions for ``size`` bytes; AQE merges those that turn out small."""
    before = spark.conf.get(_PARTITIONS, None)
    wanted = max(_partitions(spark), size // TARGET_PARTITION_BYTES)
    spark.conf.set(_PARTITIONS, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            spark.conf.unset(_PARTITIONS)
        else:
            spark.conf.set(_PARTITIONS, before)


@contextmanager
def streams_sized_for(spark: SparkSession, size: int) -> Iterator[None]:
    """A stream that starts here has ``STREAMS``, and partitions of its state enough for ``size`` bytes of input. They keep
    their number as long as its checkpoint lives, and nothing merges them."""
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // STATE_BYTES)
    wanted = STREAMS | {"spark.sql.shuffle.partitions": str(partitions)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def concurrently(*jobs: Callable[[], T]) -> list[T]:
    """Run independent Spark jobs at the same time, so a small one does not idle the cluster."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
