"""The sales tables read as movement events, territories and reference stock."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import NO_SUBCLASS, grouping_of, section_of

REFERENCE_MONTH = 200012
LAST_MONTH = 200111
#: Suppliers that are sent to all tasks: some 100 MB there.
SENT = 2_000_000


#: Spark's setting for the bytes of a generated method beyond which a stage's operators are compiled one by one.
_METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder.

    Events have many columns, so a stage that makes them would be one method of more than the 8000 bytes that HotSpot compiles, and run
    interpreted; unless the session's configuration names another limit, operators are compiled one by one there, in small methods.
    """
    if not spark.sparkContext.getConf().contains(_METHOD_BYTES):
        spark.conf.set(_METHOD_BYTES, "8000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their supplier's nation and its region.

    Up to ``SENT`` suppliers (two numbers each) are sent to the lines whatever the session's threshold, which their file may pass long before;
    beyond that their own size tells.  Otherwise every line is shuffled and sorted.
    """
    seller = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    seller = F.broadcast(seller) if seller.count() <= SENT else seller
    rows = table(spark, sf_dir, "lineitem").join(seller, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.join(F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")), F.col("s_nationkey") == F.col("n_nationkey"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a movement: feed, month, file month, place, activity, sign, wage and profile."""
    line = placed(spark, sf_dir)
    c, part = F.col, F.col("l_orderkey") % 20
    at = F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1
    month = (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("long")
    feed = F.when(part == 0, "EXC").when(part.isin(1, 2), "FOR").otherwise("MOV")
    late = at + 1 + c("l_partkey") % 12
    filed = F.when(feed == "MOV", month).otherwise(F.least((F.floor(late / 12) * 100 + late % 12 + 1).cast("long"), F.lit(LAST_MONTH).cast("long")))
    subclass = F.when(c("l_partkey") % 97 == 0, NO_SUBCLASS).otherwise((1 + c("l_partkey") % 99) * 100000 + c("l_partkey") % 100000).cast("long")
    quantity = c("l_quantity").cast("int")
    rows = line.select(
        (10 + c("n_regionkey")).cast("long").alias("state"),
        ((10 + c("n_regionkey")) * 10000 + c("n_nationkey")).cast("long").alias("municipality"),
        month.alias("month"),
        feed.alias("feed"),
        filed.alias("file_month"),
        F.when(c("l_linestatus") == "O", 1).otherwise(-1).cast("long").alias("sign"),
        subclass.alias("subclass"),
        F.when(c("l_linestatus") == "O", 10 + c("l_linenumber") % 3).otherwise(31 + c("l_linenumber") % 3).cast("long").alias("movement_type"),
        F.when(c("l_returnflag") == "R", 1).otherwise(5).alias("wage_unit"),
        F.when(c("l_discount") == 0, 0.0).otherwise(c("l_extendedprice")).alias("wage"),
        F.when(c("l_suppkey") % 11 == 0, F.lit(None)).when(quantity % 2 == 0, 1).otherwise(3).alias("sex"),
        F.when(c("l_tax") == 0, F.lit(None)).otherwise(14 + F.floor(quantity * 6 / 5).cast("int")).alias("age"),
    )
    section = F.when(c("subclass") != NO_SUBCLASS, section_of(F.floor(c("subclass") / 100000)))
    return rows.withColumn("section", F.coalesce(section, F.lit("Z"))).withColumn("grouping", grouping_of(c("section")))


def territories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """territory, kind, region, active: municipalities and whole states."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    town = n.select(((10 + F.col("n_regionkey")) * 10000 + F.col("n_nationkey")).cast("string").alias("territory"), F.lit("municipality").alias("kind"), F.when(F.col("n_nationkey") < 15, F.concat(F.lit("R"), F.col("n_regionkey"))).alias("region"), (F.col("n_nationkey") < 20).alias("active"))
    return town.union(r.select((10 + F.col("r_regionkey")).cast("string"), F.lit("state"), F.lit(None).cast("string"), F.lit(True)))


def reference_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """municipality, state, section, grouping, stock at the reference month."""
    n = F.broadcast(table(spark, sf_dir, "nation"))
    rows = table(spark, sf_dir, "customer").where("c_nationkey <> 19").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    section = section_of(1 + F.col("c_custkey") % 99)
    out = rows.select(((10 + F.col("n_regionkey")) * 10000 + F.col("n_nationkey")).cast("string").alias("municipality"), (10 + F.col("n_regionkey")).cast("string").alias("state"), F.coalesce(section, F.lit("Z")).alias("section"), (1 + F.col("c_custkey") % 50).cast("long").alias("stock"))
    return out.withColumn("grouping", grouping_of(F.col("section"))).select("municipality", "state", "section", "grouping", "stock")


def divisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """division, description: at most 99 rows, named after the first part of each."""
    number = (1 + F.col("p_partkey") % 99).cast("string")
    return table(spark, sf_dir, "part").groupBy(F.lpad(number, 2, "0").alias("division")).agg(F.min_by("p_name", "p_partkey").alias("description"))
