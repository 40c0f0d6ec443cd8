"""What an edition says: triggers, figures of the year's end, revisions, claims with known truth, and indicators around a month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import months
from ..functions.classify import UNIDENTIFIED
from ..sources.editions import last_before
from .grounding import free
from .text_and_audit import counts_said

CREDIT_SENSITIVE = ("Construção", "Comércio")
OUT = ("above", "below")


def triggers(total: DataFrame, total_season: DataFrame, notable: DataFrame, sectors: DataFrame, activities: DataFrame, shares: DataFrame, wages: DataFrame, concentration: float = 60.0, least: int = 3, least_total: int = 5) -> DataFrame:
    """territory, month, kind, detail: what a reader should look into."""
    last = F.max("month").over(Window.partitionBy("territory"))
    aged = total.withColumn("status", months.status(months.distance(F.col("month"), last)))
    parts = [
        ("provisional", aged.where("status = 'provisional'"), F.lit(None)),
        ("seasonal total", total_season.where(F.col("position").isin(*OUT)), F.col("position")),
        ("seasonal grouping", notable.where(F.col("position").isin(*OUT)), F.concat_ws(":", "grouping", "position")),
        ("concentration", sectors.where((F.col("share_of_movement") >= concentration) & (F.abs("net") >= least) & (F.col("grouping") != UNIDENTIFIED)), F.col("grouping")),
        ("dominant activity", activities, F.concat_ws(":", "grouping", "code")),
        ("small base profile", shares.where("small_base"), F.concat_ws(":", "dimension", "category")),
        ("small base wage", wages.where("small_base"), F.lit(None)),
        ("total near zero", total.where(F.abs("net") < least_total), F.lit(None)),
    ]
    return reduce(DataFrame.unionByName, [rows.select("territory", "month", F.lit(kind).alias("kind"), detail.cast("string").alias("detail")) for kind, rows, detail in parts])


def year_end(rows: DataFrame, forecast: DataFrame, bands: DataFrame) -> DataFrame:
    """Level at the year's end and the next one's, and the year's net, with bands; an edition of December looks to the next year."""
    ends = rows.groupBy("territory").agg(F.max("month").alias("last")).withColumn("year", F.floor(F.col("last") / 100) + F.when(F.col("last") % 100 == 12, 1).otherwise(0))
    banded = forecast.select("territory", "h", "month", "level").join(bands.select("territory", "h", "low", "high"), ["territory", "h"], "left")
    at = lambda name, year: banded.select("territory", (F.floor(F.col("month") / 100) - year).alias("year"), (F.col("month") % 100).alias("m"), F.col("level").alias(name), (F.col("level") + F.col("low")).alias(f"{name}_low"), (F.col("level") + F.col("high")).alias(f"{name}_high")).where("m = 12").drop("m")
    before = rows.where("month % 100 = 12").select("territory", (F.floor(F.col("month") / 100) + 1).alias("year"), F.col("level").alias("base"))
    out = ends.join(at("level_end", 0), ["territory", "year"], "left").join(at("level_next", 1), ["territory", "year"], "left").join(before, ["territory", "year"], "left")
    net = [(F.col(f"level_end{s}") - F.col("base")).alias(f"net_year{s}") for s in ("", "_low", "_high")]
    return out.select("territory", F.col("year").cast("long").alias("year"), *[n + s for n in ("level_end", "level_next") for s in ("", "_low", "_high")], *net)


def reading(figures: DataFrame) -> DataFrame:
    """Growth, contraction or stability by the sign of the whole band of the year's net."""
    label = F.when(F.col("net_year_low") > 0, "growth").when(F.col("net_year_high") < 0, "contraction").when(F.col("net_year_low").isNotNull(), "stability")
    return figures.select("territory", "year", label.alias("reading"))


def edition_rows(rows: DataFrame, forecast: DataFrame, bands: DataFrame) -> DataFrame:
    """A forecast with its band as an edition: edition is the last month of each series."""
    made = rows.groupBy("territory").agg(F.max("month").alias("edition"))
    told = forecast.join(bands.select("territory", "h", "low", "high"), ["territory", "h"], "left").join(made, "territory")
    double = [F.col(c).cast("double").alias(c) for c in ("admissions", "separations", "level")]
    net, level = F.col("admissions") - F.col("separations"), F.col("level")
    told = told.select("territory", "edition", "month", *double, net.cast("double").alias("net"), (level + F.col("low")).cast("double").alias("low"), (level + F.col("high")).cast("double").alias("high"))
    return told.select("territory", "edition", "month", "admissions", "separations", "net", "level", "low", "high")


def previous_editions(rows: DataFrame, store: DataFrame, recomputed: DataFrame) -> DataFrame:
    """territory, month, level, origin: each territory's last stored edition before the one now made; where there is none, what is ``recomputed``."""
    made = rows.groupBy("territory").agg(F.max("month").alias("edition"))
    stored = last_before(store, made).select("territory", "month", "level", F.lit("stored").alias("origin"))
    rest = recomputed.join(stored.select("territory").distinct(), "territory", "left_anti")
    return stored.union(rest.select("territory", "month", F.col("level").cast("double"), F.lit("recomputed")))


def revision(rows: DataFrame, figures: DataFrame, previous: DataFrame) -> DataFrame:
    """The last edition's forecast (``previous``: territory, month, level, perhaps origin) against what came and what is said now."""
    previous = previous if "origin" in previous.columns else previous.withColumn("origin", F.lit("recomputed"))
    now = rows.groupBy("territory").agg(F.max("month").alias("month"), F.max_by("level", "month").alias("realised"))
    then = previous.select("territory", "month", F.col("level").alias("said_of_month"))
    end = previous.select("territory", F.floor(F.col("month") / 100).alias("year"), F.col("level").alias("said_of_end"), (F.col("month") % 100).alias("m")).where("m = 12").drop("m")
    origin = previous.groupBy("territory").agg(F.first("origin").alias("origin"))
    out = now.join(then, ["territory", "month"], "left").join(origin, "territory", "left").join(figures, "territory", "left").join(end, ["territory", "year"], "left")
    wide = F.abs(F.col("level_end") - F.col("said_of_end")) > F.col("level_end_high") - F.col("level_end_low")
    return out.select("territory", "origin", "month", "said_of_month", "realised", "said_of_end", "level_end", wide.alias("beyond_band"))


def claims(levels: DataFrame, total_season: DataFrame, panorama: DataFrame, changes: DataFrame, shares: DataFrame, notable: DataFrame) -> DataFrame:
    """territory, month, family, claim, ids, truth: statements whose truth the facts settle; causes are never borne out."""

    def said(rows: DataFrame, family: str, claim: Column, ids: list[str], truth: Column) -> DataFrame:
        full = F.array(*[F.concat_ws("/", "territory", "month", F.lit(i)) for i in ids])
        return rows.select("territory", "month", F.lit(family).alias("family"), claim.alias("claim"), full.alias("ids"), truth.alias("truth"))

    named = levels.where((F.col("grouping") != UNIDENTIFIED) & (F.col("net") != 0))
    known = total_season.where("position <> 'insufficient'")
    state = panorama.where(F.length("territory") == 2).select(F.col("territory").alias("state"), "month", F.col("rate_month").alias("rate_state"))
    both = panorama.where(F.length("territory") > 2).withColumn("state", F.substring("territory", 1, 2)).join(state, ["state", "month"]).where("rate_month <> rate_state")
    turned = changes.where("from_admissions <> 0")
    women = shares.where("category = 'Mulher' and change <> 0")
    first = notable.where("rank = 1")
    text = F.lit
    parts = [said(named, "sign", F.concat(text(f"net {w}: "), "grouping"), ["net"], t) for w, t in (("positive", F.col("net") > 0), ("negative", F.col("net") < 0))]
    parts += [said(known, "band", text(f"net {p} its band"), ["net"], F.col("position") == p) for p in ("below", "inside", "above")]
    parts += [said(both, "comparison", text(f"level grew {w} than the state's"), ["rate_month", "state_rate_month"], t) for w, t in (("more", F.col("rate_month") > F.col("rate_state")), ("less", F.col("rate_month") < F.col("rate_state")))]
    parts += [said(turned, f"direction by {how}", text(f"admissions {w} over the year"), ids, t) for how, ids in (("change", ["admissions_change"]), ("levels", ["admissions", "admissions_year_ago"])) for w, t in (("fell", F.col("from_admissions") < 0), ("rose", F.col("from_admissions") > 0))]
    parts.append(said(women, "profile", text("women's share of admissions rose"), ["share_women"], F.col("change") > 0))
    parts.append(said(first, "cause", F.concat(text("interest rates moved "), "grouping"), ["net"], text(False)))
    return reduce(DataFrame.unionByName, parts)


def hits_by_family(judged: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Cases and hits of each family; a missing probability counts as 0."""
    return judged.groupBy("family").agg(F.count("*").alias("cases"), F.count_if((F.coalesce("p", F.lit(0.0)) >= threshold) == F.col("truth")).alias("hits"))


def unknown_ids(said: DataFrame, registry: DataFrame) -> DataFrame:
    """Cited ids (family, ids) that no fact has, with how often they are cited."""
    return said.select("family", F.explode("ids").alias("id")).groupBy("family", "id").agg(F.count("*").alias("n")).join(registry.select("id").distinct(), "id", "left_anti")


def trajectory(rows: DataFrame, k: int = 3) -> DataFrame:
    """Measures up to k months before and after each month; after it they stop at the first missing month, before it gaps are skipped."""
    steps = F.array(*[F.lit(i) for i in range(-k, k + 1) if i])
    asked = rows.select("territory", F.col("month").alias("base"), F.explode(steps).alias("step")).withColumn("month", months.shift(F.col("base"), F.col("step")))
    found = asked.join(rows, ["territory", "month"])
    upto = F.count("*").over(Window.partitionBy("territory", "base", F.col("step") > 0).orderBy("step"))
    return found.withColumn("upto", upto).where("step < 0 or upto = step").select("territory", F.col("base").alias("month"), F.col("month").alias("other"), F.when(F.col("step") < 0, "earlier").otherwise("later").alias("side"), "growth_n", "growth_value")


def conditional_rate(series: DataFrame, notable: DataFrame, sensitive: tuple[str, ...] = CREDIT_SENSITIVE) -> DataFrame:
    """First and last value (day, value) from a year before to the month's end, where a sector that lives on credit stands out."""
    monthly = series.groupBy((F.year("day") * 100 + F.month("day")).cast("long").alias("at")).agg(F.min_by("value", "day").alias("first"), F.max_by("value", "day").alias("last"))
    asked = notable.where(F.col("grouping").isin(*sensitive)).select("territory", "month").distinct()
    span = asked.withColumn("at", F.explode(months.between(months.shift(F.col("month"), -12), F.col("month")))).join(monthly, "at")
    return span.groupBy("territory", "month").agg(F.min_by("first", "at").alias("year_before"), F.max_by("last", "at").alias("month_end"))


def table_only(tokens: DataFrame, facts: DataFrame, in_text: DataFrame) -> DataFrame:
    """Number tokens that some fact explains, but none of those that running text may use."""
    asked = tokens.withColumn("value", F.abs("value"))
    asked = asked.where(F.col("thousands") | ~free(F.col("value")))
    return asked.join(counts_said(facts), ["value", "thousands"], "left_semi").join(counts_said(in_text), ["value", "thousands"], "left_anti")


CHUNK = r"[\p{L}\p{N}_.,$]+"


def thousands(text: Column) -> Column:
    """Dots into whole numbers of four digits and more; years (1990 to 2100) without currency or decimals stay.

    The text is cut into runs of letters, digits, dots, commas and dollar signs; a run that begins with such a number (perhaps
    after R$) has its digits grouped from the right.
    """
    runs, between = F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0)), F.split(text, CHUNK, -1)

    def shown(run: Column, at: Column) -> Column:
        sign = F.regexp_extract(run, r"^R\$", 0)
        body = F.substr(run, F.length(sign) + 1)
        whole = F.regexp_extract(body, "^[0-9]{4,}", 0)
        rest = F.substr(body, F.length(whole) + 1)
        after_sign = (at > 0) & F.coalesce(F.try_element_at(runs, at).endswith("R$"), F.lit(False)) & (F.length(F.get(between, at)) == 1)
        year = (F.length(whole) == 4) & whole.between("1990", "2100") & (sign == "") & ~after_sign & ~rest.rlike("^,[0-9]")
        plain = (whole == "") | year | rest.rlike(r"^[\p{L}\p{N}_]")
        digits = F.regexp_replace(whole, "^0+(?=[0-9])", "")
        return F.when(plain, run).otherwise(F.concat(sign, F.reverse(F.regexp_replace(F.reverse(digits), "([0-9]{3})(?=[0-9])", "$1.")), rest))

    parts = F.transform(runs, lambda run, at: F.concat(F.get(between, at), shown(run, at)))
    return F.concat(F.array_join(parts, ""), F.element_at(between, -1))
