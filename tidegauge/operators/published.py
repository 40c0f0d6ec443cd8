"""What is published: every number with an id and a unit, the hash of an edition's facts, and tables in reading order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import UNIDENTIFIED
from ..functions.style import folded

#: family: (columns that name what a number is of, number -> unit)
FAMILIES = {
    "panorama": ([], {"net": "people", "admissions": "people", "separations": "people", "stock": "people", "rate_month": "percent", "rate_year": "percent", "net_year_ago": "people"}),
    "decomposition": ([], {"change": "people", "from_admissions": "people", "from_separations": "people"}),
    "accumulated": ([], {"ytd": "people", "ytd_year_ago": "people", "last_12": "people"}),
    "sector": (["grouping"], {"net": "people", "stock": "people", "rate_month": "percent", "share_of_stock": "percent", "contribution": "percent", "share_of_movement": "percent"}),
    "highlights": (["grouping"], {"net": "people", "rest": "people"}),
    "drilldown": (["grouping", "level", "code"], {"net": "people", "net_of_rest": "people", "net_year_ago": "people", "share": "percent"}),
    "comparison": ([], {"net": "people", "stock": "people", "rate_month": "percent", "rate_year": "percent"}),
    "profile": (["dimension", "category"], {"admissions": "people", "net": "people", "share": "percent", "share_year_ago": "percent", "change": "points"}),
    "wage": ([], {"median_wage": "money", "mean_wage": "money", "n_wages": "people", "variation": "percent"}),
}


def facts_of(family: str, rows: DataFrame) -> DataFrame:
    """territory, month, id, value (two decimals), unit, description of a family's numbers; a number that is null isn't published."""
    parts, units = FAMILIES[family]
    one = lambda c, unit: F.struct(F.lit(c).alias("what"), F.col(c).cast("decimal(24,2)").alias("value"), F.lit(unit).alias("unit"))
    long = rows.select("territory", "month", *parts, F.explode(F.array(*[one(c, u) for c, u in units.items()])).alias("n")).where("n.value is not null")
    about = F.concat_ws(", ", F.lit(family), *parts)
    return long.select("territory", "month", F.concat_ws(".", F.lit(family), *[folded(F.col(p)) for p in parts], "n.what").alias("id"), "n.value", "n.unit", F.concat(F.translate("n.what", "_", " "), F.lit(" of "), about).alias("description"))


def registry(families: dict[str, DataFrame]) -> DataFrame:
    """All families' facts in one long table."""
    return reduce(DataFrame.unionByName, [facts_of(f, rows) for f, rows in families.items()])


def unique(rows: DataFrame, *keys: str) -> DataFrame:
    """The rows themselves; an error that names the first key of which there are two."""
    twice = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").orderBy(*keys).first()
    if twice:
        raise ValueError("more than one row of " + ", ".join(str(twice[k]) for k in keys))
    return rows


def canonical(columns: list[str], places: int = 2, floats: tuple[str, ...] = ()) -> Column:
    """One line of a row's columns by name order; floats are rounded to ``places`` first, so noise far down doesn't count; nulls are told from empty."""
    plain = lambda c: F.col(c).cast(f"decimal(24,{places})") if c in floats else F.col(c)
    return F.concat_ws("|", *[F.concat(F.lit(f"{c}="), F.coalesce(plain(c).cast("string"), F.lit("∅"))) for c in sorted(columns)])


def content_hash(rows: DataFrame, keys: list[str], places: int = 2) -> DataFrame:
    """keys, rows and hash of each key's rows: the same under any order of rows and columns.

    A key's rows are one edition of one place (some hundreds); only lines of digests meet, sorted, in one group.
    """
    floats = tuple(c for c, kind in rows.dtypes if kind in ("double", "float"))
    line = F.sha2(canonical([c for c in rows.columns if c not in keys], places, floats), 256)
    return rows.select(*keys, line.alias("line")).groupBy(*keys).agg(F.count("*").alias("facts"), F.sha2(F.array_join(F.sort_array(F.collect_list("line")), ""), 256).alias("hash"))


def last_but(column: str, sentinel: str = UNIDENTIFIED) -> list[Column]:
    """Order by a column with the sentinel at the end."""
    return [F.col(column) == sentinel, F.col(column)]


def grouping_table(sectors: DataFrame) -> DataFrame:
    """territory, month, place, grouping, net, stock, share_of_stock: groupings by name, the unidentified last, then the TOTAL row."""
    rows = sectors.select("territory", "month", "grouping", "net", "stock", "share_of_stock")
    total = rows.groupBy("territory", "month").agg(F.lit("TOTAL").alias("grouping"), F.sum("net").alias("net"), F.when(F.count("stock") == F.count("*"), F.sum("stock")).alias("stock"))
    both = rows.unionByName(total, allowMissingColumns=True)
    order = Window.partitionBy("territory", "month").orderBy(F.col("grouping") == "TOTAL", *last_but("grouping"))
    return both.select("territory", "month", F.row_number().over(order).alias("place"), "grouping", "net", "stock", "share_of_stock")


def regional_table(compared: DataFrame, memberships: DataFrame, states: DataFrame) -> DataFrame:
    """territory, month, place, kind, name and the comparison's measures: the territory itself, its regions, its state."""
    rank = F.when(F.col("kind") == "territory", 0).when(F.col("kind") == "region", 1).otherwise(2)
    own = states.select("territory", F.lit("territory").alias("kind"), F.col("territory").alias("name"))
    regions = memberships.select("territory", F.lit("region"), "region")
    lines = own.union(regions).union(states.select("territory", F.lit("state"), "state"))
    rows = lines.join(compared.withColumnRenamed("place", "name"), "name")
    order = Window.partitionBy("territory", "month").orderBy(rank, "name")
    return rows.select("territory", "month", F.row_number().over(order).alias("place"), "kind", "name", "net", "stock", "rate_month", "rate_year")


def profile_table(shares: DataFrame) -> DataFrame:
    """territory, month, dimension, place, category and its shares, the unidentified last."""
    order = Window.partitionBy("territory", "month", "dimension").orderBy(*last_but("category"))
    return shares.select("territory", "month", "dimension", F.row_number().over(order).alias("place"), "category", "admissions", "share", "share_year_ago", "change")
