"""Queries of the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts as M
from ..sources import tables as T
from ..sources.store import built, is_built

ANCHOR, KNOWN_UNTIL = 199912, 200006
OWN_ANCHOR, OWN_KNOWN = 200012, 200106
FIRST_LEVEL = 199901


def events(spark: SparkSession, d: str) -> DataFrame:
    """The staging table: events typed and placed once."""
    return built(spark, d, "events", lambda: T.events(spark, d))


def source(spark, d):
    """Events for a mart: the staging table where it is there already, else typed as they are read.

    A mart needs few of their columns and is itself written once, so it doesn't wait until all of them are written.
    """
    return events(spark, d) if is_built(spark, d, "events") else T.events(spark, d)


def movements(spark, d):
    """Events counted by place, grouping, month, file, feed and sign."""
    return built(spark, d, "movements", lambda: M.movement_counts(source(spark, d)))


def flagship(spark, d):
    return built(spark, d, "flagship", lambda: M.flagship(movements(spark, d)))


def wage_counts(spark, d):
    return built(spark, d, "wage_counts", lambda: M.wage_counts(source(spark, d)))


def levels(spark, d):
    return built(spark, d, "stock", lambda: M.stock(movements(spark, d), T.territories(spark, d), T.reference_stock(spark, d), T.REFERENCE_MONTH))


def region(spark, d):
    return built(spark, d, "stock_region", lambda: M.stock_region(levels(spark, d), T.territories(spark, d)))


def flow(spark, d):
    return built(spark, d, "flow", lambda: M.flow(source(spark, d), T.territories(spark, d), T.divisions(spark, d)))


def profile(spark, d):
    return built(spark, d, "profile", lambda: M.profile(source(spark, d), T.territories(spark, d)))


def wages(spark, d):
    return built(spark, d, "hiring_wage", lambda: M.hiring_wage(wage_counts(spark, d), T.territories(spark, d)))


def reconciled(spark, d):
    return built(spark, d, "reconciled", lambda: M.reconciled(movements(spark, d), place=flagship(spark, d)))


def monthly(spark, d):
    return built(spark, d, "monthly_by_grouping", lambda: M.monthly_by_grouping(movements(spark, d), wage_counts(spark, d), flagship(spark, d)))


def flagship_levels(spark, d):
    return levels(spark, d).join(F.broadcast(flagship(spark, d).select(F.col("municipality").cast("string").alias("territory"))), "territory")


def report(spark, d):
    return built(spark, d, "report_table", lambda: M.report_table(reconciled(spark, d), monthly(spark, d), flagship_levels(spark, d)))


def anchors(spark, d):
    """One anchor for all territories."""
    return T.territories(spark, d).select("territory", F.lit(ANCHOR).cast("long").alias("anchor_month"), F.lit(KNOWN_UNTIL).cast("long").alias("known_until"))


def adjustment(spark, d):
    return M.anchor_adjustment(movements(spark, d), T.territories(spark, d), anchors(spark, d))


def own_adjustment(spark, d):
    """States keep the common anchor; municipalities of even code have one of a year later, known for longer."""
    later = (F.length("territory") > 2) & (F.col("territory").cast("long") % 2 == 0)
    own = anchors(spark, d).withColumn("anchor_month", F.when(later, F.lit(OWN_ANCHOR).cast("long")).otherwise(F.col("anchor_month")))
    own = own.withColumn("known_until", F.when(later, F.lit(OWN_KNOWN).cast("long")).otherwise(F.col("known_until")))
    return M.anchor_adjustment(movements(spark, d), T.territories(spark, d), own)


def series_12(spark, d):
    """The twelve points of each month, a row a point."""
    points = M.report_series(report(spark, d)).select("month", F.posexplode("series").alias("place", "p"))
    return points.select("month", "place", F.col("p.month").alias("at"), "p.admissions", "p.separations", "p.net", "p.stock")


def sources(spark, d):
    """What a report is made of with the reconciled mart, and without it."""
    with_mart, without = M.report_source(reconciled(spark, d), monthly(spark, d)), M.report_source(None, monthly(spark, d))
    return with_mart.withColumn("has_mart", F.lit(True)).union(without.withColumn("has_mart", F.lit(False)))


def levels_from(spark, d):
    """Levels with a first month before which none is told."""
    return M.stock(movements(spark, d), T.territories(spark, d), T.reference_stock(spark, d), T.REFERENCE_MONTH, first_level=FIRST_LEVEL)


QUERIES = {
    "stg_events": lambda s, d: events(s, d),
    "stg_reference_stock": lambda s, d: T.reference_stock(s, d),
    "effect_on_balance": lambda s, d: M.effects(events(s, d), T.territories(s, d)),
    "monthly_by_grouping": monthly,
    "reconciled": reconciled,
    "stock": levels,
    "stock_region": region,
    "flow": flow,
    "profile": profile,
    "hiring_wage": wages,
    "anchor_adjustment": adjustment,
    "anchor_adjustment_own": own_adjustment,
    "report_series": series_12,
    "report_source": sources,
    "stock_from": levels_from,
    "report_table": report,
    "report_summary": lambda s, d: M.report_summary(report(s, d), reconciled(s, d)),
}
