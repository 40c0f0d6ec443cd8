"""The store of editions: a table that outlives runs, in which an edition of a territory is replaced as a whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .feeds import replace_by_key

#: Besides territory and edition (the month it was made of).
COLUMNS = ["month", "admissions", "separations", "net", "level", "low", "high"]


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def save(rows: DataFrame, path: str) -> None:
    """Stores editions (territory, edition, COLUMNS): those of a territory that are there already are replaced, all others stay.

    The table is laid out by edition.  Other territories' rows of the same editions are written again with the new ones, first beside the
    table, then in its place, so a failure midway leaves it as it was.
    """
    spark, beside = rows.sparkSession, f"{path}-staged-{uuid.uuid4().hex}"
    new = rows.select("territory", "edition", *COLUMNS)
    if exists(spark, path):
        old = spark.read.parquet(path).select(*new.columns)
        same = old.join(new.select("edition").distinct(), "edition", "left_semi")
        new = new.unionByName(same.join(new.select("territory", "edition").distinct(), ["territory", "edition"], "left_anti"))
    new.write.parquet(beside)
    replace_by_key(spark.read.parquet(beside), path, "edition")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All editions; an empty table if none has been stored."""
    if not exists(spark, path):
        return spark.createDataFrame([], "territory string, edition long, " + ", ".join(f"{c} {'long' if c == 'month' else 'double'}" for c in COLUMNS))
    return spark.read.parquet(path).withColumn("edition", F.col("edition").cast("long"))


def last_before(store: DataFrame, current: DataFrame) -> DataFrame:
    """The rows of each territory's last edition before its current one (territory, edition)."""
    now = current.select("territory", F.col("edition").alias("now"))
    last = store.select("territory", "edition").distinct().join(now, "territory").where("edition < now").groupBy("territory").agg(F.max("edition").alias("edition"))
    return store.join(last, ["territory", "edition"])
