"""Queries of file sources and sinks: what the tables hold is written as files of each kind and scanned back, with SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import marts as M
from ..sources import feeds
from ..sources import tables as T
from ..sources.store import shared_dir
from . import analyses as Q
from .marts import levels, movements
from .sql import sql

STATE = "12"


def folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/files-{name}-{uuid.uuid4().hex}"


def scan_reference_stock(s, d):
    path = folder(s, "reference")
    rows = T.reference_stock(s, d).select("municipality", "section", "grouping", F.col("stock").cast("string"))
    rows.write.option("sep", ";").option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return feeds.reference_scan(s, path, STATE)


def scan_panel(s, d):
    path = folder(s, "panel")
    rows = levels(s, d).select(F.col("territory").alias("\ufeffterritory"), "grouping", F.col("month").cast("string").alias("month"), F.col("stock").cast("string").alias("stock"))
    rows.repartition(4, "grouping").write.option("sep", ";").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)
    return feeds.panel_scan(s, path).select("territory", "grouping", "month", "stock", (F.length("file_name") > 0).alias("from_file"))


def scan_ledger(s, d):
    path = folder(s, "ledger")
    Q.entries(s, d).write.json(path)
    return feeds.ledger_scan(s, path).select("run", "entry", "kind", "cents")


def scan_indicator(s, d):
    path = folder(s, "indicator")
    orders = T.table(s, d, "orders").join(T.table(s, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    month = (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long")
    counts = orders.groupBy(F.col("c_nationkey").cast("string").alias("town"), month.alias("month")).agg(F.count("*").alias("n"))
    counts.groupBy("town").agg(F.sort_array(F.collect_list(F.struct("month", "n"))).alias("series")).write.json(path)  # a town's months
    return feeds.indicator_scan(s, path)


def export_levels(s, d):
    path = folder(s, "export")
    feeds.export_long(levels(s, d), path)
    return s.read.schema("territory string, month long, grouping string, net long, stock long").option("header", True).csv(path)


def replaced_reference(s, d):
    """The table after two whole loads, of which the second stays, with the rows of both in the log."""
    path = folder(s, "replaced")
    rows = M.reference_by_territory(T.reference_stock(s, d), T.territories(s, d))
    feeds.replace_whole(rows, path, f"{path}-log", "first")
    feeds.replace_whole(rows.where("reference > 100"), path, f"{path}-log", "second")
    log = s.read.parquet(f"{path}-log").agg(F.sum("rows").alias("rows_loaded"))
    return s.read.parquet(path).crossJoin(F.broadcast(log))  # one row


def pending_files(s, d):
    files = movements(s, d).select("feed", "file_month").distinct()
    return feeds.pending(files, files.where("file_month < 200101"), files.where("feed = 'MOV' and file_month < 200107"), redo=[200012])


QUERIES = {f.__name__: f for f in (scan_reference_stock, scan_panel, scan_ledger, scan_indicator, export_levels, replaced_reference, pending_files)}

SQL = {
    "scan_reference_stock": sql(f"""select municipality, section, "grouping", stock from refm where state='{STATE}'"""),
    "scan_panel": sql("""select territory, "grouping", month, stock, true as from_file from level"""),
    "scan_ledger": "select user_id as run, event_id as entry, case event_type when 'signup' then 'reserve' when 'purchase' then 'call' else 'close' end as kind, cast(round(value*100) as bigint) as cents from events where event_type in ('signup','purchase','error')",
    "scan_indicator": "select cast(c_nationkey as varchar) as town, cast(year(o_orderdate)*100+month(o_orderdate) as bigint) as month, count(*) as n from orders join customer on c_custkey=o_custkey group by 1,2",
    "export_levels": sql("""select territory, month, "grouping", net, stock from level union all select territory, month, 'TOTAL', cast(sum(net) as bigint), case when count(stock)=count(*) then cast(sum(stock) as bigint) end from level group by 1,2"""),
    "replaced_reference": sql("""select *, cast((select count(*)+count(*) filter (reference>100) from ref) as bigint) as rows_loaded from ref where reference>100"""),
    "pending_files": sql("select distinct feed, file_month from ev where file_month=200012 or (file_month>=200101 and not (feed='MOV' and file_month<200107))"),
}
