"""Streams of feeds: exactly-once ingest of files, and counts that late corrections keep revising."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.classify import effect
from ..sources.editions import exists
from ..sources.feeds import replace_by_key, upsert, with_load_key


def ingest(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Takes each new file of a folder once into ``target``, partitioned by feed, file month and file.

    A batch that is run again replaces its own files' partitions, so the result is the same; two files of one feed and month stay side by side.
    """
    rows = spark.readStream.schema(schema).option("sep", ";").option("header", True).csv(folder)
    rows = with_load_key(rows.withColumn("file_name", F.col("_metadata.file_name")))
    keys = ("feed", "file_month", "file_name")
    return rows.writeStream.foreachBatch(lambda batch, _: replace_by_key(batch, target, *keys)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reconcile(events: DataFrame) -> DataFrame:
    """Net effect by month and grouping of a stream (or table) of events.

    There is no watermark: exclusions reach back for years, and a month's status only says how likely it is still to change.
    """
    return events.groupBy("month", "grouping").agg(F.sum(effect(F.col("feed"), F.col("sign"))).alias("net"), F.count("*").alias("rows"))




def with_keys(events: DataFrame) -> DataFrame:
    """Each event under two keys: its month and grouping, and its file; a key's digest is a sum of row hashes, so it doesn't depend on order."""
    flow = F.struct(F.lit("flow").alias("kind"), F.col("month").alias("month"), F.col("grouping").alias("name"), F.lit(None).cast("string").alias("feed"))
    file = F.struct(F.lit("file").alias("kind"), F.col("file_month").alias("month"), F.col("file_name").alias("name"), F.col("feed").alias("feed"))
    return events.withColumn("key", F.explode(F.array(flow, file)))


def kept(events: DataFrame) -> DataFrame:
    """The state: kind, month, name, feed with counts, bytes and digest, of a stream in update mode or of a table in one pass.

    ``events``: feed, file_month, file_name, bytes (of the file), month, grouping, sign.
    """
    weight = F.when(F.col("feed") == "EXC", -1).otherwise(1)
    side = lambda s: F.coalesce(F.sum(F.when(F.col("sign") == s, weight)), F.lit(0))
    line = F.xxhash64("feed", "file_month", "month", "grouping", "sign").cast("decimal(38,0)")
    keyed = with_keys(events).groupBy(F.col("key.kind").alias("kind"), F.col("key.month").alias("month"), F.col("key.name").alias("name"), F.col("key.feed").alias("feed"))
    return keyed.agg(side(1).alias("admissions"), side(-1).alias("separations"), F.sum(effect(F.col("feed"), F.col("sign"))).alias("net"), F.count("*").alias("rows"), F.max("bytes").alias("bytes"), F.sha2(F.sum(line).cast("string"), 256).alias("digest"))


def feeds_stream(spark: SparkSession, folders: list[str], schema: str) -> DataFrame:
    """The union of streams of feed files (one a folder), with file_name, bytes, feed and file_month out of each file's name."""
    read = lambda f: spark.readStream.schema(schema).option("sep", ";").option("header", True).csv(f).select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("bytes"))
    return with_load_key(reduce(DataFrame.unionByName, [read(f) for f in folders]))


def _replace(rows: DataFrame, path: str, *keys: str) -> None:
    """Upserts rows into a small kept table; written beside it first, so a failure midway leaves it as it was."""
    spark, beside = rows.sparkSession, f"{path}-staged-{uuid.uuid4().hex}"
    new = upsert(spark.read.parquet(path), rows, *keys) if exists(spark, path) else rows
    new.write.parquet(beside)
    spark.read.parquet(beside).write.mode("overwrite").parquet(path)


def reconcile_feeds(spark: SparkSession, folders: list[str], schema: str, state: str, registry: str, checkpoint: str) -> StreamingQuery:
    """Keeps ``state`` (month, grouping: reconciled counts) and ``registry`` (feed, file month, file: rows, bytes, digest) as files arrive.

    One query: three streams united, one stateful grouping whose changed keys come out in update mode, both tables written by the same
    batch.  What comes out are totals, never increments, so a batch that is run again changes nothing; after each batch the
    state is what ``kept`` gives over all files taken so far.
    """

    def write(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        flows = batch.where("kind = 'flow'").select("month", F.col("name").alias("grouping"), "admissions", "separations", "net", "rows")
        files = batch.where("kind = 'file'").select("feed", F.col("month").alias("file_month"), F.col("name").alias("file_name"), "rows", "bytes", "digest")
        _replace(flows, state, "month", "grouping")
        _replace(files, registry, "feed", "file_month", "file_name")
        batch.unpersist()

    rows = kept(feeds_stream(spark, folders, schema))
    return rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily(events: DataFrame) -> DataFrame:
    """Tumbling days over event time, for tables and streams alike."""
    return events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "event_type", "n")
