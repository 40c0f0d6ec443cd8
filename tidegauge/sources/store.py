"""Marts as tables: each is computed once an application and folder, and read by all that build on it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_BUILT: dict[tuple[str, str, str], str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``); on one machine, without it, a fresh local one."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    key = (spark.sparkContext.applicationId, "", "")
    if key not in _BUILT:
        _BUILT[key] = tempfile.mkdtemp(prefix="spark-marts-")
    return _BUILT[key]


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether the table's writer finished and the table is still there."""
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)


def built(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The mart ``name`` of a folder's tables, written by the first that asks for it in this application.

    The tables of a folder are taken not to change while an application runs; ``forget`` makes the next reader build anew.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _BUILT or not _complete(spark, _BUILT[key]):
        path = f"{shared_dir(spark)}/mart-{name}-{uuid.uuid4().hex}"
        make().write.parquet(path)
        _BUILT[key] = path
    return spark.read.parquet(_BUILT[key])


def is_built(spark: SparkSession, sf_dir: str, name: str) -> bool:
    return (spark.sparkContext.applicationId, sf_dir, name) in _BUILT


def forget(sf_dir: str) -> None:
    """Marts of a folder whose tables have changed are built anew."""
    for key in [k for k in _BUILT if k[1] == sf_dir]:
        del _BUILT[key]
