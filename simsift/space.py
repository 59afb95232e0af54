"""Tables and files in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: What dealing out a small table may move for each core.
SPREAD_BYTES = 128 << 20


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only where driver and executors are one machine's single process
    (tests) a missing setting is filled in; a cluster without it is refused."""
    root = spark.conf.get(SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="simsift-")
        spark.conf.set(SETTING, root)
    return root.rstrip("/")


#: Folders made in this process, and those made since the innermost `kept_until_done` of a thread began.
_made: list[str] = []
_own: ContextVar[list[str] | None] = ContextVar("own", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    folder = f"{shared_dir(spark)}/simsift/{label}-{uuid.uuid4().hex}"
    own = _own.get()
    (_made if own is None else own).append(folder)
    return folder


@contextmanager
def kept_until_done(spark: SparkSession):
    """A job's intermediate tables and files, which are deleted at its end; other threads' stay."""
    token = _own.set(own := [])
    try:
        yield
    finally:
        _own.reset(token)
        _delete(spark, own)


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here, and lost executors lose nothing."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, whichever store it lies in, and the path as it knows it."""
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), name


def _delete(spark: SparkSession, folders: list[str]) -> None:
    while folders:
        where, path = hadoop_path(spark, folders.pop())
        where.delete(path, True)


def discard(spark: SparkSession) -> None:
    """Deletes the intermediate tables and files of this process. Call it once results are saved:
    frames that still read them can't be run again."""
    _delete(spark, _made)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(table: DataFrame) -> DataFrame:
    """A table of fewer files than there are cores and at most SPREAD_BYTES a core, dealt out to all of them:
    a file may be one row group, so one task. Others are read as they lie, without a shuffle."""
    cores = table.sparkSession.sparkContext.defaultParallelism
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return table.repartition(cores) if size <= cores * SPREAD_BYTES and len(table.inputFiles()) < cores else table
