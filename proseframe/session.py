"""Session helpers shared by tests, the bench and the streaming jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, name: str = "proseframe") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PROSEFRAME_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("PROSEFRAME_SHARED") or tempfile.mkdtemp(prefix="proseframe-"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # bounds the memory of a Python worker where texts are long
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .getOrCreate()
    )


def shared_base(spark: SparkSession, base: str | None = None) -> str:
    """The folder that driver and executors share.

    ``base`` if given, else the session's ``spark.checkpoint.dir``. Only a
    ``local`` master, where all tasks run on this machine, may fall back to a
    temporary folder; a cluster without a shared folder is an error.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("no shared folder: set spark.checkpoint.dir to one that all executors can read and write")
    if "base" not in _LOCAL:
        _LOCAL["base"] = tempfile.mkdtemp(prefix="proseframe-")
    return _LOCAL["base"]


#: the temporary folder of a local session that names none
_LOCAL: dict[str, str] = {}


#: paths handed out within each open :func:`intermediate_tables`
_OPEN: ContextVar[tuple[list[str], ...]] = ContextVar("open", default=())


def shared_dir(spark: SparkSession, purpose: str, base: str | None = None) -> str:
    """A fresh path in the shared folder (see :func:`shared_base`)."""
    path = f"{shared_base(spark, base)}/{purpose}-{uuid.uuid4().hex}"
    for scope in _OPEN.get()[-1:]:
        scope.append(path)
    return path


@contextmanager
def intermediate_tables(spark: SparkSession) -> Iterator[None]:
    """Removes at its end what was written to the shared folder within it.

    Results read such tables lazily: write or collect what is to stay before
    the end. Without it intermediate tables stay until the folder is cleared.
    """
    mine: list[str] = []
    token = _OPEN.set((*_OPEN.get(), mine))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in mine:
            remove(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of this name in any store Spark reaches."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that ``write_through`` made."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_through(df, purpose: str):
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage with a durable table, so the loss of an executor
    costs no recomputation of the steps before it.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
