"""Facts by rule: of all territories and months at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import months
from ..functions.classify import UNIDENTIFIED, percent


def totals(flow: DataFrame, levels: DataFrame) -> DataFrame:
    """territory, month: admissions, separations, net and level (null unless all groupings have one)."""
    f = flow.groupBy("territory", "month").agg(F.sum("admissions").alias("admissions"), F.sum("separations").alias("separations"))
    s = levels.groupBy("territory", "month").agg(F.sum("net").alias("net"), F.when(F.count("stock") == F.count("*"), F.sum("stock")).alias("stock"))
    out = s.join(f, ["territory", "month"], "left")
    return out.withColumn("admissions", F.coalesce("admissions", F.lit(0))).withColumn("separations", F.coalesce("separations", F.lit(0)))


def ago(rows: DataFrame, k: int, names: dict[str, str], *keys: str) -> DataFrame:
    """``rows``' columns as seen k months later, under new names (a join on the month, so gaps don't matter)."""
    return rows.select(*keys, months.shift(F.col("month"), k).alias("month"), *[F.col(a).alias(b) for a, b in names.items()])


def panorama(total: DataFrame) -> DataFrame:
    out = total.join(ago(total, 1, {"stock": "stock_before"}, "territory"), ["territory", "month"], "left")
    out = out.join(ago(total, 12, {"net": "net_year_ago", "stock": "stock_year_ago"}, "territory"), ["territory", "month"], "left")
    rate = percent(F.col("stock") - F.col("stock_before"), F.col("stock_before"))
    return out.withColumn("rate_month", rate).withColumn("rate_year", percent(F.col("stock") - F.col("stock_year_ago"), F.col("stock_year_ago")))


def decomposition(total: DataFrame) -> DataFrame:
    """Change of net against a year ago by admissions and separations, and which of them drives it."""
    out = total.join(ago(total, 12, {"admissions": "a", "separations": "s"}, "territory"), ["territory", "month"])
    up, down = F.col("admissions") - F.col("a"), -(F.col("separations") - F.col("s"))
    out = out.select("territory", "month", up.alias("from_admissions"), down.alias("from_separations"), (up + down).alias("change"))
    x, y = F.col("from_admissions"), F.col("from_separations")
    both = (x * y > 0) & (3 * F.least(F.abs(x), F.abs(y)) >= F.greatest(F.abs(x), F.abs(y)))
    return out.withColumn("driver", F.when(both, "both").when(F.abs(x) >= F.abs(y), "admissions").otherwise("separations"))


def accumulated(total: DataFrame) -> DataFrame:
    """Year to date, the same a year before, and twelve months (null unless all twelve exist)."""
    year = Window.partitionBy("territory", F.floor(F.col("month") / 100)).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    twelve = Window.partitionBy("territory").orderBy(months.index(F.col("month"))).rangeBetween(-11, 0)
    out = total.select("territory", "month", F.sum("net").over(year).alias("ytd"), F.when(F.count("*").over(twelve) == 12, F.sum("net").over(twelve)).alias("last_12"))
    return out.join(ago(out, 12, {"ytd": "ytd_year_ago"}, "territory"), ["territory", "month"], "left")


def seasonality(levels: DataFrame, least_years: int = 3) -> DataFrame:
    """Net of a month against the band of the same month in earlier years."""
    past = Window.partitionBy("territory", "grouping", F.col("month") % 100).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    out = levels.select("territory", "grouping", "month", "net", F.min("net").over(past).alias("low"), F.max("net").over(past).alias("high"), F.count("net").over(past).alias("years"))
    place = F.when(F.col("years") < least_years, "insufficient").when(F.col("net") > F.col("high"), "above").when(F.col("net") < F.col("low"), "below").otherwise("inside")
    return out.withColumn("position", place)


def sector(levels: DataFrame, flow: DataFrame, least_total: int = 5) -> DataFrame:
    """Flows, level and monthly rate, share of level, contribution to the total net, and share of absolute movement of each grouping."""
    by = Window.partitionBy("territory", "month")
    total, moved = F.sum("net").over(by), F.sum(F.abs("net")).over(by)
    whole = F.when(F.count("stock").over(by) == F.count(F.lit(1)).over(by), F.sum("stock").over(by))
    before = F.lag("stock").over(Window.partitionBy("territory", "grouping").orderBy("month"))
    out = levels.select("territory", "month", "grouping", "net", "stock", total.alias("total"), moved.alias("moved"), whole.alias("whole"), percent(F.col("net"), before).alias("rate_month"))
    flows = flow.groupBy("territory", "month", "grouping").agg(F.sum("admissions").alias("admissions"), F.sum("separations").alias("separations"))
    out = out.join(flows, ["territory", "month", "grouping"], "left")
    contribution = F.when(F.abs("total") >= least_total, percent(F.col("net"), F.col("total")))
    return out.select(
        "territory", "month", "grouping", "net", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("admissions", "separations")], "stock", "rate_month",
        percent(F.col("stock"), F.col("whole")).alias("share_of_stock"), contribution.alias("contribution"), percent(F.abs("net"), F.col("moved")).alias("share_of_movement"),
    )


def highlights(season: DataFrame, k: int = 2, least: int = 3) -> DataFrame:
    """The k largest balances by size, above a minimum and identified, and any such grouping out of its band.

    ``rest`` is the joint balance of all groupings that aren't highlights, the unidentified one included; null where there is none.
    """
    fit = (F.col("grouping") != UNIDENTIFIED) & (F.abs("net") >= least)
    place = Window.partitionBy("territory", "month", "fit").orderBy(F.desc(F.abs("net")), "grouping")
    ranked = season.withColumn("fit", fit).withColumn("rank", F.row_number().over(place))
    chosen = ranked.withColumn("chosen", F.col("fit") & ((F.col("rank") <= k) | F.col("position").isin("above", "below")))
    rest = F.sum(F.when(~F.col("chosen"), F.col("net"))).over(Window.partitionBy("territory", "month"))
    return chosen.withColumn("rest", rest).where("chosen").select("territory", "month", "grouping", "net", "position", "rank", "rest")


def persistence(chosen: DataFrame, levels: DataFrame) -> DataFrame:
    """The balances of highlights in the two months before, null where the series has none."""
    keys = ["territory", "grouping"]
    out = chosen.select(*keys, "month", "net")
    for k in (1, 2):
        out = out.join(ago(levels, k, {"net": f"net_{k}_before"}, *keys), [*keys, "month"], "left")
    return out


def comparison(levels: DataFrame, region: DataFrame) -> DataFrame:
    """Territories, regions and states side by side: net, level and its rates over one and twelve months; absent if a grouping has no level."""
    a = levels.select(F.col("territory").alias("place"), "month", "net", "stock")
    rows = a.union(region.select("region", "month", "net", "stock"))
    out = rows.groupBy("place", "month").agg(F.sum("net").alias("net"), F.sum("stock").alias("stock"), F.count_if(F.col("stock").isNull()).alias("gaps")).where("gaps = 0").drop("gaps")
    both = out.join(ago(out, 1, {"stock": "before"}, "place"), ["place", "month"], "left").join(ago(out, 12, {"stock": "year_ago"}, "place"), ["place", "month"], "left")
    return both.select("place", "month", "net", "stock", percent(F.col("net"), F.col("before")).alias("rate_month"), percent(F.col("stock") - F.col("year_ago"), F.col("year_ago")).alias("rate_year"))


def drilldown(flow: DataFrame, chosen: DataFrame, share: float = 0.4, most: int = 3) -> DataFrame:
    """Activities with ``share`` of a highlighted grouping's movement over twelve months, at most ``most`` a territory and month.

    Subgroupings come first; only a grouping without a dominant one goes down to its divisions.  A level at which the grouping has
    but one activity says nothing; the unidentified division counts in the whole and is never chosen.  ``net_of_rest`` is the
    balance of the grouping without the activity.  The largest balances by size stay, ties by grouping and code.
    """
    keys = ["territory", "grouping", "level", "code"]
    pair = F.explode(F.array(F.struct(F.lit("subgrouping").alias("level"), F.col("subgrouping").alias("code"), F.col("subgrouping").alias("name")), F.struct(F.lit("division").alias("level"), F.col("division").alias("code"), F.col("description").alias("name"))))
    long = flow.withColumn("pair", pair).select("territory", "grouping", "month", "pair.*", "admissions", "separations", "net")
    moved = long.groupBy(*keys, "month").agg(*[F.sum(c).alias(c) for c in ("admissions", "separations", "net")], F.min("name").alias("name"))
    codes = moved.groupBy("territory", "grouping", "level").agg(F.count_distinct(F.coalesce("code", F.lit(""))).alias("codes"))
    asked = chosen.select("territory", "grouping", F.col("month").alias("at"), F.col("net").alias("of_net"), F.explode(F.sequence(F.lit(0), F.lit(12))).alias("back"))
    asked = asked.withColumn("month", months.shift(F.col("at"), -F.col("back")))
    on = lambda k, c: F.sum(F.when(F.col("back") == k, F.col(c)).otherwise(0))
    year = asked.join(moved, ["territory", "grouping", "month"]).groupBy(*keys, "at", "of_net").agg(
        F.min("name").alias("name"), F.sum(F.when(F.col("back") < 12, F.col("admissions") + F.col("separations")).otherwise(0)).alias("moved"),
        on(0, "net").alias("net"), on(0, "admissions").alias("admissions"), on(0, "separations").alias("separations"), on(12, "net").alias("net_year_ago"),
    )
    whole = F.sum("moved").over(Window.partitionBy("territory", "grouping", "level", "at"))
    large = year.withColumn("of", whole).join(codes, ["territory", "grouping", "level"]).where((F.col("codes") > 1) & (F.col("of") > 0) & (F.col("moved") >= share * F.col("of")) & (F.col("code") != "NI"))
    first = large.withColumn("top", F.max("level").over(Window.partitionBy("territory", "grouping", "at"))).where("level = top")
    place = Window.partitionBy("territory", "at").orderBy(F.desc(F.abs("net")), "grouping", "code")
    kept = first.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= most)
    return kept.select("territory", "grouping", F.col("at").alias("month"), "level", "code", "name", "net", (F.col("of_net") - F.col("net")).alias("net_of_rest"), "admissions", "separations", "net_year_ago", "moved", percent(F.col("moved"), F.col("of")).alias("share"), "rank")


def profile_share(profile: DataFrame, least: int = 20, points: float = 5.0, base: int = 30) -> DataFrame:
    """Share of admissions by category, that of a year ago, and the change in points.

    A category of fewer than ``base`` admissions is small; one that is neither small nor unidentified is relevant if its balance is at
    least ``least`` by size or its share changed by ``points`` or more.
    """
    of = F.sum("admissions").over(Window.partitionBy("territory", "month", "dimension"))
    share = profile.select("territory", "month", "dimension", "category", "admissions", "separations", "net", F.when(of > 0, percent(F.col("admissions"), of)).alias("share"), of.alias("base"))
    out = share.join(ago(share, 12, {"share": "share_year_ago"}, "territory", "dimension", "category"), ["territory", "dimension", "category", "month"], "left")
    out = out.withColumn("change", F.round(F.col("share") - F.col("share_year_ago"), 2)).withColumn("small_base", F.col("admissions") < base).withColumn("unidentified", F.col("category") == UNIDENTIFIED)
    told = (F.abs("net") >= least) | F.coalesce(F.abs("change") >= points, F.lit(False))
    return out.withColumn("relevant", ~F.col("small_base") & ~F.col("unidentified") & told)


def wage(wages: DataFrame, least: int = 30) -> DataFrame:
    out = wages.join(ago(wages, 12, {"median_wage": "median_year_ago"}, "territory"), ["territory", "month"], "left")
    return out.withColumn("variation", percent(F.col("median_wage") - F.col("median_year_ago"), F.col("median_year_ago"))).withColumn("small_base", F.col("n_wages") < least)


def registry(total: DataFrame) -> DataFrame:
    """Every published number as a row: id, value, unit."""
    long = total.unpivot(["territory", "month"], ["admissions", "separations", "net", "stock"], "measure", "value").where("value is not null")
    return long.select(F.concat_ws("/", "territory", F.col("month").cast("string"), "measure").alias("id"), F.col("value").cast("long").alias("value"), F.lit("people").alias("unit"))
