"""Shared scratch storage and lineage cuts.

Everything written here goes under the folder the cluster names in
``spark.checkpoint.dir``. Written parquet survives the loss of executors,
unlike cached blocks.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITTEN: list[str] = []  # scratch folders of this process that still exist
_LOCK = threading.Lock()
_OWN = threading.local()  # a list of scratch folders for each ``own_scratch`` block of a thread, the innermost last
_WRITES: Counter[str] = Counter()  # writes under way, by application
_BEFORE: dict[str, str | None] = {}  # their application's setting before the first of them


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach.

    Only a local session without the setting gets a temporary folder; on a
    cluster a missing setting is an error, never a machine-local path.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_SETTING, None
    )
    if folder:
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_SETTING} is {folder}: executors of a cluster do not share such a folder")
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="landledger-")
    spark.conf.set(CHECKPOINT_SETTING, folder)
    return folder


def _own_blocks() -> list[list[str]]:
    if not hasattr(_OWN, "blocks"):
        _OWN.blocks = []
    return _OWN.blocks


def fresh_path(spark: SparkSession, label: str) -> str:
    """Unused path in the shared folder, removed by ``release`` or at the end of a ``scratch`` block."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    with _LOCK:
        _WRITTEN.append(path)
    if blocks := _own_blocks():
        blocks[-1].append(path)
    return path


def file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder if it exists."""
    files, target = file_system(spark, path)
    files.delete(target, True)


def replace_folder(spark: SparkSession, new: str, target: str) -> None:
    """Put the complete folder ``new`` where ``target`` is; until then the old one stays readable."""
    files, to = file_system(spark, target)
    _, source = file_system(spark, new)
    _, old = file_system(spark, f"{target}.old-{uuid.uuid4().hex}")
    replaces = files.exists(to)
    if replaces and not files.rename(to, old):
        raise OSError(f"cannot move {target} aside")
    if not files.rename(source, to):
        raise OSError(f"cannot move {new} to {target}")
    if replaces:
        files.delete(old, True)


def release(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch folders written so far, from the ``since``-th on, and return their number.

    Call it when results that read them have been written.
    """
    with _LOCK:
        paths = _WRITTEN[since:]
        del _WRITTEN[since:]
    for path in paths:
        remove(spark, path)
    return len(paths)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch written inside the block goes at its end, when the block has written its results.

    Blocks may be nested, but not run side by side.
    """
    with _LOCK:
        since = len(_WRITTEN)
    try:
        yield
    finally:
        release(spark, since)


@contextmanager
def own_scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch that this thread writes inside the block goes at its end; blocks of several threads may run side by side."""
    _own_blocks().append([])
    try:
        yield
    finally:
        paths = _own_blocks().pop()
        with _LOCK:
            _WRITTEN[:] = [p for p in _WRITTEN if p not in paths]
        for path in paths:
            remove(spark, path)


@contextmanager
def surviving() -> Iterator[None]:
    """Scratch written inside the block outlives the ``own_scratch`` block around it."""
    own = _own_blocks().pop()
    try:
        yield
    finally:
        _own_blocks().append(own)


@contextmanager
def shuffles_cleaned(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that runs inside the block go when it ends; nothing reads them again.

    Spark else keeps them until the driver happens to collect its garbage, so that a chain of writes holds the shuffles of
    all its steps. Blocks may run side by side; the setting is put back when the last one ends, and lazy results keep theirs.
    """
    own = spark.sparkContext.applicationId
    with _LOCK:
        if not _WRITES[own]:
            _BEFORE[own] = spark.conf.get(CLEANUP_SETTING, None)
            spark.conf.set(CLEANUP_SETTING, "true")
        _WRITES[own] += 1
    try:
        yield
    finally:
        with _LOCK:
            _WRITES[own] -= 1
            if not _WRITES[own]:
                before = _BEFORE.pop(own)
                spark.conf.unset(CLEANUP_SETTING) if before is None else spark.conf.set(CLEANUP_SETTING, before)


def materialise(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and go on from the written table; ``compression`` in place of the session's codec."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with shuffles_cleaned(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def materialise_built(spark: SparkSession, build: Callable[[], DataFrame], label: str, compression: str | None = None) -> DataFrame:
    """``materialise`` of what ``build`` returns; the scratch it wrote on the way goes as soon as the table is written."""
    path = fresh_path(spark, label)
    with own_scratch(spark), shuffles_cleaned(spark):
        df = build()
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def run_together(jobs: Sequence[Callable], at_once: int = 6) -> list:
    """Run independent small jobs side by side and return their results in order.

    Small aggregates leave most of a cluster idle while they wait for their own
    stages, so several of them share it.
    """
    spark = SparkSession.getActiveSession()
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        # wrapped here, in the caller's thread, whose properties the jobs inherit
        return list(pool.map(lambda job: job(), [inheritable_thread_target(spark)(j) for j in jobs]))
