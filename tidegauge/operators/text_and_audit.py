"""Counts in text, calibration of thresholds, external comparisons, ledgers and indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import months
from ..functions.classify import percent
from .grounding import free

def counts_said(facts: DataFrame) -> DataFrame:
    """value, thousands: a count as it is, and in thousands with one decimal or none (halves up)."""
    v = F.abs("value").cast("decimal(24,6)")
    ways = F.array(F.struct(v.alias("value"), F.lit(False).alias("thousands")), *[F.struct(F.round(v * F.lit(0.001).cast("decimal(4,3)"), k).cast("decimal(24,6)").alias("value"), F.lit(True).alias("thousands")) for k in (0, 1)])
    both = facts.where("value is not null").select(F.explode(ways).alias("w")).select(F.col("w.value").cast("double").alias("value"), "w.thousands")
    exact = facts.where("value is not null").select((F.abs("value") / 1000.0).cast("double").alias("value"), F.lit(True).alias("thousands"))
    return both.union(exact).distinct()


def ungrounded_counts(tokens: DataFrame, facts: DataFrame) -> DataFrame:
    """Number tokens that no fact explains, before "mil" by its value in thousands; 1 to 12 and years are free."""
    asked = tokens.withColumn("value", F.abs("value"))
    return asked.where(F.col("thousands") | ~free(F.col("value"))).join(counts_said(facts), ["value", "thousands"], "left_anti")


def sweep(scored: DataFrame, miss: int = 3) -> DataFrame:
    """Each threshold's errors and cost over (truth, p); ``best`` marks the middle of the cheapest."""
    t = scored.select("truth", "p", F.explode(F.transform(F.sequence(F.lit(1), F.lit(9)), lambda k: k / 10.0)).alias("threshold"))
    yes = F.col("p") >= F.col("threshold")
    out = t.groupBy("threshold").agg(F.count_if(yes & ~F.col("truth")).alias("fp"), F.count_if(~yes & F.col("truth")).alias("fn"), F.count("*").alias("n"))
    out = out.withColumn("cost", miss * F.col("fp") + F.col("fn")).withColumn("accuracy", F.round((F.col("n") - F.col("fp") - F.col("fn")) / F.col("n"), 4))
    least = F.min("cost").over(Window.partitionBy())
    ranked = out.withColumn("tied", F.col("cost") == least)
    by = Window.partitionBy("tied")
    k = F.row_number().over(by.orderBy("threshold"))
    middle = F.floor((F.count("*").over(by) + 1) / 2)
    return ranked.withColumn("best", F.col("tied") & (k == middle)).drop("tied", "n")


def reliability(scored: DataFrame) -> DataFrame:
    """Five equal bins of p, the last closed: rows and share true."""
    return scored.groupBy(F.least(F.floor(F.col("p") * 5), F.lit(4)).cast("long").alias("bin")).agg(F.count("*").alias("n"), F.round(F.avg(F.col("truth").cast("int")), 4).alias("share_true"))


def ledger_runs(entries: DataFrame) -> DataFrame:
    """run: calls, cost, and what it commits (reserve while open, if larger)."""
    agg = entries.groupBy("run").agg(F.count_if(F.col("kind") == "call").alias("calls"), F.coalesce(F.sum(F.when(F.col("kind") == "call", F.col("cents"))), F.lit(0)).alias("cost"), F.coalesce(F.max_by("cents", F.when(F.col("kind") == "reserve", F.struct("at", "entry"))), F.lit(0)).alias("reserve"), F.bool_or(F.col("kind") == "close").alias("closed"))
    return agg.withColumn("committed", F.when(F.col("closed"), F.col("cost")).otherwise(F.greatest("reserve", "cost")))


def compare(ours: DataFrame, official: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row a key and measure with its status; a delta only where both sides have a value."""
    long = lambda df, v: df.unpivot(keys, measures, "measure", v).withColumn(f"in_{v}", F.lit(True))
    both = long(ours, "ours").join(long(official, "official"), [*keys, "measure"], "full")
    a, b = F.col("ours"), F.col("official")
    status = F.when(F.col("in_ours").isNull(), "missing here").when(F.col("in_official").isNull(), "missing there").when(a.eqNullSafe(b), "equal").when(a.isNull() | b.isNull(), "null against value").otherwise("different")
    return both.select(*keys, "measure", "ours", "official", status.alias("status"), (a - b).alias("delta"))


def multiset_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose counts differ."""
    a, b = (df.groupBy(*keys).agg(F.count("*").alias(n)) for df, n in ((left, "n_left"), (right, "n_right")))
    both = a.join(b, keys, "full").withColumn("n_left", F.coalesce("n_left", F.lit(0))).withColumn("n_right", F.coalesce("n_right", F.lit(0)))
    return both.where("n_left <> n_right")


def residual(rows: DataFrame, total: str, named: list[str]) -> DataFrame:
    """The category that a table leaves out: total - sum of the named ones; null if one of them is missing."""
    wide = rows.groupBy("month").pivot("grouping", [total, *named]).agg(F.first("net"))
    rest = F.col(f"`{total}`") - sum((F.col(f"`{n}`") for n in named[1:]), F.col(f"`{named[0]}`"))
    return wide.select("month", rest.alias("residual"))


def yearly_growth(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys (territory), month: count and value in cents with their growth over twelve months."""
    by = list(keys or ("territory",))
    past = rows.select(*by, months.shift(F.col("month"), 12).alias("month"), F.col("n").alias("n_before"), F.col("cents").alias("cents_before"))
    growth = lambda c: percent(F.col(c) - F.col(f"{c}_before"), F.col(f"{c}_before"))
    return rows.join(past, [*by, "month"]).select(*by, "month", "n", "cents", growth("n").alias("growth_n"), growth("cents").alias("growth_value"))


def ledger_months(entries: DataFrame) -> DataFrame:
    """month, runs, committed: what each month's own entries commit, a run's reserve while no entry of the month closes it."""
    month = (F.year("at") * 100 + F.month("at")).cast("long")
    dated = entries.withColumn("month", month).withColumn("run", F.struct("month", "run"))
    runs = ledger_runs(dated)
    return runs.groupBy(F.col("run.month").alias("month")).agg(F.count("*").alias("runs"), F.sum("committed").alias("committed"))


def residual_status(rows: DataFrame, given: DataFrame, total: str, named: list[str]) -> DataFrame:
    """month, residual, given, status of the category that a table leaves out.

    incomplete: the total or a named category is missing; derived: nothing is given; agrees or differs: what is given (month, net) against
    total - sum of the named ones.
    """
    both = residual(rows, total, named).join(given.select("month", F.col("net").alias("given")), "month", "left")
    status = F.when(F.col("residual").isNull(), "incomplete").when(F.col("given").isNull(), "derived").when(F.col("given") == F.col("residual"), "agrees")
    return both.select("month", "residual", "given", status.otherwise("differs").alias("status"))


def renamed(official: DataFrame, names: dict[str, str], column: str = "grouping") -> DataFrame:
    """An official table under our names; two of its names for one of ours is an error, a name that isn't mapped stays."""
    twice = sorted({ours for ours in names.values() if list(names.values()).count(ours) > 1})
    if twice:
        raise ValueError(f"more than one name is mapped to {', '.join(twice)}")
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return official.withColumn(column, F.coalesce(known[F.col(column)], F.col(column)))


def with_totals(rows: DataFrame, measures: list[str], total: str = "TOTAL") -> DataFrame:
    """Rows (month, grouping, measures) with a total row a month, unless the month has one; a measure that is null in all is null."""
    have = rows.where(F.col("grouping") == total).select("month").distinct()
    sums = rows.where(F.col("grouping") != total).groupBy("month").agg(F.lit(total).alias("grouping"), *[F.sum(m).alias(m) for m in measures])
    return rows.select("month", "grouping", *measures).unionByName(sums.join(have, "month", "left_anti").select("month", "grouping", *measures))
