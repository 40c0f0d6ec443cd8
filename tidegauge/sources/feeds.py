"""Delimited feeds: by-name, all-string scans, idempotent replacement by key, and the registry of files."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEED_FILE = r"([A-Z]+)(\d{6})\.txt$"


def scan(spark: SparkSession, paths: Iterable[str], sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """All columns as strings, files united by column name, with file_name.

    Spark reads a file's columns by place, so files are grouped by their header line and each group is read
    with its own.  Only header lines are read ahead (one row a file).  A byte-order mark before the first name is dropped.
    """
    lines = spark.read.option("encoding", encoding).option("lineSep", "\n").text(list(paths)).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    first = lines.where("at = 0").groupBy("path").agg(F.first("value").alias("header"))
    by_header: dict[str, list[str]] = {}
    for r in first.collect():
        by_header.setdefault(r["header"].strip("﻿\r\n"), []).append(r["path"])
    if not by_header:
        raise ValueError("no file to scan")
    parts = []
    for header, files in sorted(by_header.items()):
        schema = ", ".join(f"`{c}` string" for c in header.split(sep))
        rows = spark.read.schema(schema).option("sep", sep).option("header", True).option("encoding", encoding).option("enforceSchema", True).option("mode", "FAILFAST").csv(sorted(files))
        parts.append(rows.withColumn("file_name", F.col("_metadata.file_name")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def with_load_key(rows: DataFrame) -> DataFrame:
    """feed and file_month out of the file's name."""
    return rows.withColumn("feed", F.regexp_extract("file_name", FEED_FILE, 1)).withColumn("file_month", F.regexp_extract("file_name", FEED_FILE, 2).cast("long"))


def cast_columns(rows: DataFrame, spec: dict[str, tuple[str, str]], keep: Iterable[str] = ()) -> DataFrame:
    """Typed projection from a dictionary name -> (raw name, type); doubles may have a decimal comma; junk is an error."""

    def one(raw: str, kind: str) -> Column:
        value = F.nullif(F.trim(F.col(f"`{raw}`")), F.lit(""))
        return (F.replace(value, F.lit(","), F.lit(".")) if kind == "double" else value).cast(kind)

    return rows.select(*[one(raw, kind).alias(name) for name, (raw, kind) in spec.items()], *keep)


def replace_by_key(rows: DataFrame, path: str, *keys: str) -> None:
    """Replaces the partitions that occur in ``rows`` and leaves all others; an empty batch changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def registry_rows(staged: DataFrame) -> DataFrame:
    """feed, file_month, rows of what is staged."""
    return staged.groupBy("feed", "file_month").agg(F.count("*").alias("rows"))


def upsert(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """Old rows whose key isn't among the new ones, and the new; columns that one side lacks are null."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def pending(published: DataFrame, registry: DataFrame, staged: DataFrame | None = None, redo: Iterable[int] = ()) -> DataFrame:
    """Published files not yet taken in, oldest month first, then MOV, FOR, EXC.

    A file is taken in if the registry has it; an on-time file also if its month is ``staged`` (file_month).  Months in ``redo`` are
    wanted again in any case.
    """
    rank = F.when(F.col("feed") == "MOV", 0).when(F.col("feed") == "FOR", 1).otherwise(2)
    done = registry.select("feed", "file_month")
    if staged is not None:
        done = done.union(staged.select(F.lit("MOV"), "file_month")).distinct()
    done = done.where(~F.col("file_month").isin(*redo)) if redo else done
    return published.join(done, ["feed", "file_month"], "left_anti").orderBy("file_month", rank)


def strict_scan(spark: SparkSession, path: str, columns: list[str], sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """All-string rows of files whose header is exactly ``columns`` and whose lines have exactly as many fields; anything else is an error."""
    reader = spark.read.schema(", ".join(f"`{c}` string" for c in columns)).option("sep", sep).option("header", True).option("encoding", encoding)
    return reader.option("enforceSchema", False).option("mode", "FAILFAST").option("quote", "").csv(path)


def reference_scan(spark: SparkSession, path: str, state: str) -> DataFrame:
    """municipality, section, grouping, stock of one state's municipalities from a reference-stock file."""
    rows = strict_scan(spark, path, ["municipality", "section", "grouping", "stock"])
    return cast_columns(rows.where(F.col("municipality").startswith(state)), {"municipality": ("municipality", "string"), "section": ("section", "string"), "grouping": ("grouping", "string"), "stock": ("stock", "long")})


def panel_scan(spark: SparkSession, path: str) -> DataFrame:
    """territory, grouping, month, stock (empty: null) and file_name of a folder of panel files; a byte-order mark may lead each."""
    spec = {"territory": ("territory", "string"), "grouping": ("grouping", "string"), "month": ("month", "long"), "stock": ("stock", "long")}
    return cast_columns(scan(spark, [path]), spec, keep=["file_name"])


def ledger_scan(spark: SparkSession, path: str) -> DataFrame:
    """run, entry, kind, at, cents of a ledger in JSON lines; a line that doesn't fit is an error."""
    return spark.read.schema("run long, entry long, kind string, at timestamp, cents long").option("mode", "FAILFAST").json(path)


def indicator_scan(spark: SparkSession, path: str) -> DataFrame:
    """town, month, n of an indicator's JSON: one object a municipality with its months."""
    rows = spark.read.schema("town string, series array<struct<month: long, n: long>>").option("mode", "FAILFAST").json(path)
    return rows.select("town", F.explode("series").alias("v")).select("town", "v.month", "v.n")


def pinned_scan(spark: SparkSession, folder: str, feed: str, month: int | str = "*") -> DataFrame:
    """All-string rows of one feed's files of one month, or of every month (``*``), out of a folder laid out by feed and file_month.

    The month is part of the path that is listed, so no other month's file is even looked at.  No file: an error, as of any path.
    """
    reader = spark.read.option("basePath", folder).option("sep", ";").option("header", True).option("inferSchema", False).option("mode", "FAILFAST")
    rows = reader.csv(f"{folder}/feed={feed}/file_month={month}")
    return rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in rows.columns])


def seed_scan(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A typed dimension out of CSV: the header must be the schema's names in order; a value of another type is an error."""
    reader = spark.read.schema(schema).option("sep", sep).option("header", True).option("enforceSchema", False)
    return reader.option("mode", "FAILFAST").option("nullValue", "").csv(path)


def folder_scan(spark: SparkSession, path: str) -> DataFrame:
    """All-string rows of a folder of CSV files, united by name, each with its file's name."""
    return scan(spark, [path], sep=",")


def rate_scan(spark: SparkSession, path: str) -> DataFrame:
    """day and value of a rate's JSON (days as dd/MM/yyyy, values as text with a decimal point); a day that doesn't parse is an error."""
    rows = spark.read.schema("data string, valor string").option("mode", "FAILFAST").json(path)
    return rows.select(F.to_date("data", "dd/MM/yyyy").alias("day"), F.col("valor").cast("double").alias("value"))


def replace_whole(rows: DataFrame, path: str, log_path: str, label: str) -> None:
    """Replaces the whole table and adds a line to the load log, only after all rows have been written elsewhere."""
    staged = f"{path}-staged"
    rows.write.mode("overwrite").parquet(staged)
    whole = rows.sparkSession.read.parquet(staged)
    whole.write.mode("overwrite").parquet(path)
    whole.agg(F.lit(label).alias("label"), F.count("*").alias("rows"), F.current_timestamp().alias("at")).write.mode("append").parquet(log_path)


def export_long(levels: DataFrame, path: str) -> None:
    """Levels with a TOTAL row a territory and month, by month, territory, TOTAL first, grouping, as CSV; a repeated key is an error."""
    total = levels.groupBy("territory", "month").agg(F.lit("TOTAL").alias("grouping"), F.sum("net").alias("net"), F.when(F.count("stock") == F.count("*"), F.sum("stock")).alias("stock"))
    rows = levels.select("territory", "month", "grouping", "net", "stock").unionByName(total)
    twice = rows.groupBy("territory", "month", "grouping").agg(F.count("*").alias("n")).where("n > 1").first()
    if twice:
        raise ValueError(f"more than one row of {twice['territory']}, {twice['month']}, {twice['grouping']}")
    order = ["month", "territory", F.col("grouping") != "TOTAL", "grouping"]
    rows.orderBy(*order).write.option("header", True).csv(path)
