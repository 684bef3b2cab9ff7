"""Tables in the folder that all machines see."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines see, from ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine, as in tests, is a temporary folder
    made and set; a cluster without the setting is an error, as its machines would not see it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster see")
        found = tempfile.mkdtemp(prefix="helixframe-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


class Written(list):
    """Paths of the tables that were written in a block, the last one last; ``pop`` takes one out, for the block around it, if any."""

    def __init__(self, outer: Written | None):
        super().__init__()
        self.outer = outer

    def pop(self, at: int = -1) -> str:
        path = super().pop(at)
        if self.outer is not None:
            self.outer.append(path)
        return path


#: The block that is open in this thread or task of the driver, if any. Blocks of other threads are not seen.
_open: ContextVar[Written | None] = ContextVar("helixframe_written", default=None)
#: Tables that are still there, with their sessions; they are removed when the process ends.
_left: dict[str, SparkSession] = {}


def note(spark: SparkSession, path: str) -> None:
    """Remember that a folder below the shared one was written, for the block around it or the end of the process."""
    if not _left:
        atexit.register(_remove_left)
    _left.setdefault(path, spark)
    if (block := _open.get()) is not None:
        block.append(path)


def _remove_left() -> None:
    """At the end of the process: what no block removed, as far as the session still runs."""
    for path, spark in list(_left.items()):
        try:
            if spark.sparkContext._jsc is not None:
                remove(spark, [path])
        except Exception:  # Spark may have ended on its own; the folder is then left
            return


def remove(spark: SparkSession, paths: list) -> None:
    """Delete tables that ``materialize`` or ``write_shared`` wrote; results that still read them can no longer be computed."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        _left.pop(path, None)


@contextmanager
def temporary(spark: SparkSession):
    """Remove at the end what is written inside, but for the paths that are popped from the list that it gives.

    Blocks nest, and what is popped from an inner one belongs to the outer one. Each thread has blocks
    of its own, so work in other threads keeps its tables.
    """
    block = Written(_open.get())
    token = _open.set(block)
    try:
        yield block
    finally:
        _open.reset(token)
        remove(spark, block)


def write_shared(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df`` as Parquet to a new folder below the shared one, in a folder for each value of ``partition_by``."""
    note(df.sparkSession, path)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a read of that table, not the work before it.
    """
    path = f"{shared_dir(df.sparkSession)}/helixframe-{uuid.uuid4().hex}"
    write_shared(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
