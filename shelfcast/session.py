"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every shelfcast job expects: ANSI arithmetic (bad input raises, as
# the pandas original does), UTC session clock, adaptive execution for runtime
# broadcast / skew-join / partition coalescing decisions.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "shelfcast", extra: dict | None = None) -> SparkSession:
    """Get or create a session with the settings above.

    On a cluster pass ``master=None`` and let spark-submit decide; tests use
    ``local[*]`` with a handful of shuffle partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


# Folders written by this process, by application, until ``clear_scratch``.
_written: dict[str, list[str]] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    A cluster names its shared folder in ``spark.checkpoint.dir``; that value
    always wins.  Only a single-process session (master ``local`` or
    ``local[...]``) without one, as in tests, gets a fresh temporary folder.
    Everywhere else, ``local-cluster`` included, a machine-local folder would be
    invisible to the executors, so a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        conf_dir = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove every folder that :func:`scratch_dir` gave this application; how many there were.

    For the end of a job: frames that read those tables can't be used afterwards.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    return sum(_delete(spark, path) for path in paths)


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Remove one folder that :func:`scratch_dir` gave, once nothing reads it any more."""
    _written.get(spark.sparkContext.applicationId, []).remove(path)
    return _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in this block remove the shuffle files of their own plan when they are done.

    Nothing reads them again: later work starts from the table.  Without it they stay until the
    driver happens to collect its garbage, and a chain of tables keeps all of them on disk.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, name: str, how: str | None = "parquet") -> DataFrame:
    """Cut the lineage of ``df``.

    ``parquet``: write a Parquet table under ``spark.checkpoint.dir`` and read
    it back; later branches then scan it with column pruning and pushed
    filters, and a lost executor costs a re-read, not a recomputation.
    ``checkpoint``: Spark's reliable ``DataFrame.checkpoint``.
    ``None``: keep one lazy plan (small inputs, plan inspection).
    """
    if how is None:
        return df
    spark = df.sparkSession
    if how == "checkpoint":
        return df.checkpoint(eager=True)
    if how == "parquet":
        path = scratch_dir(spark, name)
        with shuffle_files_dropped(spark):
            df.write.mode("error").parquet(path)
        return spark.read.parquet(path)
    raise ValueError(f"unknown materialization {how!r}")


#: Rows up to which the written side of a join is broadcast.
SMALL_ROWS = 500_000


def small_side(df: DataFrame, name: str, how: str | None = "parquet", rows: int = SMALL_ROWS) -> DataFrame:
    """The side of a join that is expected to be the small one, written first.

    Left to the adaptive planner, both sides are shuffled before their sizes are known, so the lines
    are moved for a table of a few rows.  Written, its rows are counted; up to ``rows`` of them are
    broadcast, more are joined as the planner sees fit.
    """
    table = materialize(df, name, how)
    return F.broadcast(table) if how is not None and table.count() <= rows else table
