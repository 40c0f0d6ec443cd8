"""Data-quality rules: each takes marts and returns the rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import months
from ..functions.classify import UNIDENTIFIED

SEVERITY_ERROR, SEVERITY_WARN = "error", "warn"


def stock_coherent(levels: DataFrame) -> DataFrame:
    """A level that doesn't move by its month's net flow."""
    before = F.lag("stock").over(Window.partitionBy("territory", "grouping").orderBy("month"))
    return levels.select("territory", "grouping", "month", "net", (F.col("stock") - before).alias("moved")).where("moved is not null and moved <> net")


def same_net(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Full comparison of sums by key; a side without a row counts zero."""
    a = left.groupBy(*keys).agg(*[F.sum(v).alias(f"{v}_left") for v in values])
    b = right.groupBy(*keys).agg(*[F.sum(v).alias(f"{v}_right") for v in values])
    both = a.join(b, keys, "full")
    for v in values:
        both = both.withColumn(f"{v}_left", F.coalesce(f"{v}_left", F.lit(0))).withColumn(f"{v}_right", F.coalesce(f"{v}_right", F.lit(0)))
    return both.where(reduce(Column.__or__, [F.col(f"{v}_left") != F.col(f"{v}_right") for v in values]))


def missing_months(rows: DataFrame, key: str, month: str) -> DataFrame:
    """Months between the first and the last of all rows that a key lacks."""
    span = rows.agg(F.min(month).alias("lo"), F.max(month).alias("hi")).select(F.explode(months.between(F.col("lo"), F.col("hi"))).alias(month))
    have = rows.select(key, month).distinct()
    return have.select(key).distinct().crossJoin(F.broadcast(span)).join(have, [key, month], "left_anti")


def stock_matches_reference(levels: DataFrame, reference: DataFrame, month: int) -> DataFrame:
    """Levels at the reference month that aren't the reference (null-safe)."""
    at = levels.where(F.col("month") == month).select("territory", "grouping", "stock")
    both = at.join(reference, ["territory", "grouping"], "left").withColumn("reference", F.when(F.col("stock").isNotNull(), F.coalesce("reference", F.lit(0))))
    return both.where(~F.col("stock").eqNullSafe(F.col("reference")))


def negative(levels: DataFrame, unidentified: bool) -> DataFrame:
    kind = (F.col("grouping") == UNIDENTIFIED) == F.lit(unidentified)
    return levels.where(kind & (F.col("stock") < 0)).select("territory", "grouping", "month", "stock")


def exclusion_sign(events: DataFrame) -> DataFrame:
    """Exclusions whose sign isn't the one that their movement type always has on time."""
    constant = events.where("feed = 'MOV'").groupBy("movement_type").agg(F.min("sign").alias("lo"), F.max("sign").alias("hi")).where("lo = hi")
    return events.where("feed = 'EXC'").join(F.broadcast(constant), "movement_type").where("sign <> lo").groupBy("movement_type").agg(F.count("*").alias("n"))


def wage_range(wages: DataFrame, low: float = 500, high: float = 6000) -> DataFrame:
    out = ~F.col("median_wage").between(low, high) | ~F.col("mean_wage").between(low, high)
    return wages.where(out).select("territory", "month", "median_wage", "mean_wage")


def mean_vs_median(monthly: DataFrame, ratio: float = 1.2, least: int = 5) -> DataFrame:
    return monthly.where((F.col("n_wages") >= least) & (F.col("mean_wage") > ratio * F.col("median_wage"))).select("month", "grouping", "n_wages", "median_wage", "mean_wage")


def repeated(rows: DataFrame, *grain: str) -> DataFrame:
    return rows.groupBy(*grain).agg(F.count("*").alias("n")).where("n > 1")


def repeated_in(marts: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """mart, n of every key of a mart that occurs more than once."""
    return reduce(DataFrame.union, [repeated(rows, *grain).select(F.lit(name).alias("mart"), "n") for name, (rows, grain) in marts.items()])


def same_by(rows: DataFrame, column: str, values: list[str], other: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Keys, one part of ``rows`` at a time, whose sums differ from the other's, with the part they are of."""
    parts = [same_net(rows.where(F.col(column) == v), other, keys, measures).withColumn(column, F.lit(v)) for v in values]
    return reduce(DataFrame.unionByName, parts)


def volume_anomaly(counts: DataFrame, key: str, share: float = 0.5, least: int = 3) -> DataFrame:
    """Months with less than ``share`` of the median of the key's other months.

    The median without one value comes from the sorted list's middle: at most one place moves, so no
    self join is needed.  The list is a key's months.
    """
    by = Window.partitionBy(key)
    sorted_n = F.array_sort(F.collect_list("n").over(by))
    rank = F.row_number().over(by.orderBy("n", "month"))
    rest = F.concat(F.slice(F.col("all"), F.lit(1), F.col("rank") - 1), F.slice(F.col("all"), F.col("rank") + 1, F.size("all")))
    got = counts.select(key, "month", "n", sorted_n.alias("all"), rank.alias("rank")).where(F.size("all") > least).withColumn("rest", rest)
    half = F.floor(F.size("rest") / 2).cast("int")
    median = F.when(F.size("rest") % 2 == 1, F.element_at("rest", half + 1).cast("double")).otherwise((F.element_at("rest", half) + F.element_at("rest", half + 1)) / 2.0)
    return got.withColumn("median_others", median).where(F.col("n") < share * F.col("median_others")).select(key, "month", "n", "median_others")


def generic(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One scan for many column rules: rule, violations."""
    counts = rows.agg(*[F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def summary(checks: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """check, severity, violations, status."""
    parts = [df.agg(F.lit(name).alias("check"), F.lit(severity).alias("severity"), F.count("*").alias("violations")) for name, (severity, df) in checks.items()]
    status = F.when(F.col("violations") == 0, "PASS").when(F.col("severity") == SEVERITY_WARN, "WARN").otherwise("ERROR")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def not_unique(rows: DataFrame, *keys: str) -> DataFrame:
    """One row: how many rows share their keys with another (rows with a null key aren't looked at)."""
    twice = rows.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return twice.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("violations"))


def unrelated(rows: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """One row: how many rows have a value that the dimension lacks (a null relates to nothing and isn't counted)."""
    lone = rows.where(F.col(column).isNotNull()).join(dimension.select(F.col(key).alias(column)).distinct(), column, "left_anti")
    return lone.agg(F.count("*").alias("violations"))


def named_rules(rules: dict[str, DataFrame]) -> DataFrame:
    """rule and violations of rules that each give one row."""
    from functools import reduce

    return reduce(DataFrame.unionByName, [one.select(F.lit(name).alias("rule"), "violations") for name, one in rules.items()])
