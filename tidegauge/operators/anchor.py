"""A level anchored at a zero mark: typed anchors, their checks, and what an official snapshot says of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def anchor_stock(rows: DataFrame) -> DataFrame:
    """Typed anchors out of all-string rows: the month of the reference date and the last correcting file known then."""
    day = F.col("reference_date").cast("date")
    return rows.select("territory", F.trim("grouping").alias("grouping"), F.col("stock").cast("long").alias("stock"), day.alias("reference_date"), (F.year(day) * 100 + F.month(day)).cast("long").alias("anchor_month"), F.col("known_until").cast("long").alias("known_until"), "source", F.regexp_extract("file_name", "[^/]+$", 0).alias("file_name"))


def incomplete(anchors: DataFrame, groupings: int = 6) -> DataFrame:
    """Territories without exactly one row a grouping, one date and one cut."""
    out = anchors.groupBy("territory").agg(F.count("*").alias("rows"), F.countDistinct("grouping").alias("groupings"), F.countDistinct("reference_date").alias("dates"), F.countDistinct("known_until").alias("cuts"))
    return out.where((F.col("rows") != groupings) | (F.col("groupings") != groupings) | (F.col("dates") != 1) | (F.col("cuts") != 1))


def snapshot_difference(panel: DataFrame, anchors: DataFrame, effects: DataFrame) -> DataFrame:
    """Panel rows (territory, grouping, month, panel_stock, panel_known_until) that the anchor and the files known then don't give.

    Effects are summed by month and file first, so that a key's rows are bounded by months times files.
    """
    key = ["territory", "grouping"]
    e = effects.groupBy(*key, F.col("month").alias("at"), "file_month", (F.col("feed") != "MOV").alias("late")).agg(F.sum("effect").alias("effect"))
    flow = (F.col("at") > F.col("anchor_month")) & (F.col("at") <= F.col("month"))
    amended = F.col("late") & (F.col("at") <= F.col("anchor_month")) & (F.col("file_month") > F.col("known_until"))
    counts = (F.col("file_month") <= F.col("panel_known_until")) & (flow | amended)
    rows = panel.join(anchors.select(*key, "stock", "anchor_month", "known_until"), key).join(e, key, "left")
    out = rows.groupBy(*key, "month", "panel_stock", "stock").agg(F.coalesce(F.sum(F.when(counts, F.col("effect"))), F.lit(0)).alias("moved"))
    return out.select(*key, "month", "panel_stock", (F.col("stock") + F.col("moved")).alias("rebuilt")).where("panel_stock <> rebuilt").withColumn("difference", F.col("rebuilt") - F.col("panel_stock"))


def pair_validation(rows: DataFrame, total: str = "TOTAL") -> DataFrame:
    """Groups against the independent total of each month; levels are only observed, a missing one isn't filled in."""
    part, whole = F.col("grouping") != total, F.col("grouping") == total
    gap = lambda c: (F.coalesce(F.sum(F.when(part, F.col(c))), F.lit(0)) - F.coalesce(F.sum(F.when(whole, F.col(c))), F.lit(0))).alias(f"{c}_gap")
    out = rows.groupBy("month").agg(
        F.count_if(whole).alias("totals"),
        F.count_if(part).alias("groups"),
        (F.count_if(part) - F.countDistinct(F.when(part, F.col("grouping")))).alias("repeated"),
        F.count_if(F.coalesce("admissions", F.lit(0)) - F.coalesce("separations", F.lit(0)) != F.coalesce("net", F.lit(0))).alias("incoherent"),
        *[gap(c) for c in ("admissions", "separations", "net")],
        F.count_if(part & F.col("stock").isNull()).alias("stock_missing"),
        F.coalesce(F.sum(F.when(part, F.col("stock"))), F.lit(0)).alias("stock_sum"),
        F.max(F.when(whole, F.col("stock"))).alias("stock_total"),
    )
    bad = (F.col("totals") != 1) | (F.col("repeated") > 0) | (F.col("incoherent") > 0) | (F.col("admissions_gap") != 0) | (F.col("separations_gap") != 0) | (F.col("net_gap") != 0)
    return out.withColumn("valid", ~bad).withColumn("observe", (F.col("stock_missing") > 0) | ~F.col("stock_sum").eqNullSafe(F.col("stock_total")))


def content_change(loads: DataFrame) -> DataFrame:
    """State of each load (source, at, entry, content): unavailable (null content), loaded, same or changed, by hash of the content."""
    seen = loads.withColumn("digest", F.sha2("content", 256))
    before = F.last("digest", ignorenulls=True).over(Window.partitionBy("source").orderBy("at", "entry").rowsBetween(Window.unboundedPreceding, -1))
    state = F.when(F.col("digest").isNull(), "unavailable").when(F.col("before").isNull(), "loaded").when(F.col("before") == F.col("digest"), "same").otherwise("changed")
    return seen.withColumn("before", before).select("source", "entry", state.alias("state"))
