"""Session helpers: the shared scratch folder and materialised intermediates."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may go
    without one; it then gets a fresh temporary folder for the life of the session.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tremora-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _own(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tremora-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in this application's part of the scratch folder.

    The part goes when the driver's Python ends with the session still running, or by
    ``drop_scratch``.
    """
    if _own(spark) not in _owned:
        _owned.add(_own(spark))
        atexit.register(_at_exit, spark)
    return f"{_own(spark)}/{name}-{uuid.uuid4().hex}"


_owned: set[str] = set()


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results that still read them are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _owned.discard(_own(spark))


def _at_exit(spark: SparkSession) -> None:
    try:
        if not spark.sparkContext._jsc.sc().isStopped():
            drop_scratch(spark)
    except Exception:  # the JVM is gone already; nothing can be deleted through it
        pass


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings that hold inside the block only."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder as Parquet and read it back.

    Cuts lineage with files that outlive any executor, pins values that are not
    stable under recomputation (partition ids), and later reads stay pruned.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Hint a broadcast of a narrow side only once its rows are known to be few.

    At most ``max_rows`` + 1 rows are fetched. If that is all, they come back as a
    local table; otherwise ``df`` is returned as it is, so the join shuffles (and
    adaptive execution splits skewed partitions).
    """
    head = df.limit(max_rows + 1).toArrow()
    if head.num_rows > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(head, df.schema))
