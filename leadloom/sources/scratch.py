"""Shared folder for tables that cut a long lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CONF = "spark.checkpoint.dir"
_own: dict[str, str | None] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``.

    Where it names none a local session gets a temporary folder; a cluster must
    name one that all executors see.
    """
    named = spark.conf.get(_CONF, None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_CONF} to a folder that all executors can reach")
        # the setting cannot be changed in a running session, so the folder is remembered here
        named = _own.setdefault(spark.sparkContext.applicationId, None) or tempfile.mkdtemp(prefix="leadloom-")
        _own[spark.sparkContext.applicationId] = named
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


# folders made since each open ``cleaned`` began
_open: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, inside the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/leadloom/{label}-{uuid.uuid4().hex}"
    for made in _open:
        made.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of scratch that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, every folder that was made inside.

    For jobs whose results are written elsewhere before the end; frames that still
    read from scratch cannot be used afterwards.
    """
    made: list[str] = []
    _open.append(made)
    try:
        yield
    finally:
        _open.remove(made)
        for path in made:
            remove(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to Parquet in the shared folder and read back.

    Cuts the lineage like a checkpoint and survives the loss of executors; unlike
    one it keeps column pruning and filter pushdown for its readers.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# so many rows of a few numbers or keys may pass through the driver on their way to all tasks
FEW = 1 << 17


def shuffled(df: DataFrame) -> DataFrame:
    """``df``, which grows with the data, never to pass through the driver for a join.

    Left alone Spark sends all tasks what takes few bytes in files or between
    stages; what is compressed well there can be many times larger on the driver.
    """
    return df.hint("merge")


def sized(df: DataFrame) -> DataFrame:
    """``df``, narrow and cheap to count, to be sent to all tasks in joins if it is counted to have few rows, else shuffled."""
    return F.broadcast(df) if df.count() <= FEW else shuffled(df)
