"""Stage storage in the shared folder of the cluster.

A stage is written once and read back: the plan behind it is cut, lost executors cost
nothing, and the file sizes tell the optimizer whether the result is small enough to
broadcast. What a stage was shuffled through is of no use once it is written, so those
files go with the write, not whenever the driver happens to collect its garbage.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CODEC = "zstd"  # stages are mostly ids: about half the size that snappy leaves
PASS_ROWS = 1 << 24
MOST_PASSES = 8
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would not be seen by the other machines, so that is an error.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if folder:
        return folder.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_SETTING} to a folder that every executor can reach")
        _own[app] = tempfile.mkdtemp(prefix="ledgerlift-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside leave no shuffle files; a later query of the same plan makes its own."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def passes_for(rows: int) -> int:
    """In how many passes to exchange ``rows`` that do not shrink on the way, so that only one pass is on disk at a time."""
    return max(1, min(MOST_PASSES, -(-rows // PASS_ROWS)))


def unstage(df: DataFrame, *names: str) -> None:
    """Remove the stages called ``names`` among those that ``df`` reads, when nothing reads them any more."""
    spark = df.sparkSession
    own = re.compile(f"/(?:{'|'.join(map(re.escape, names))})-[0-9a-f]{{32}}$")
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if own.search(folder):
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with freed_shuffles(spark):
        df.write.mode("overwrite").parquet(path, compression=_CODEC)
    return spark.read.schema(df.schema).parquet(path)


def counted_write(df: DataFrame, path: str, compression: str | None = None) -> int:
    """Write ``df`` to ``path`` and return its number of rows, counted while it is written."""
    seen = Observation()
    with freed_shuffles(df.sparkSession):
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path, compression=compression)
    return seen.get.get("n", 0)  # an empty table may be written without a pass


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stage`` and the number of rows, from the one pass that writes them."""
    path = new_path(df.sparkSession, name)
    rows = counted_write(df, path, _CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path), rows
