"""Who is meant: requests resolved against a catalogue of places, and members of the regions that a place lies in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.style import folded

KINDS = ("municipality", "state")


def resolve(requests: DataFrame, catalogue: DataFrame) -> DataFrame:
    """request, status, kind, code, name of every request (request, kind, code, state, name).

    A request is sought by its code if it has one, else by its folded name within its state, in ``catalogue`` (kind, code, state, name); exactly one
    place must answer.  Statuses: unknown kind, not found, ambiguous, name conflict (the code's place has another folded name),
    duplicate (an earlier request is the same place, by request number), matched.  Both ways are equality joins; a place
    that is listed twice alike counts once.  A request without code and name isn't found; requests of the same number are told apart by their rows.
    """
    one_code = F.col("code").isNotNull()
    asked = requests.select("request", "kind", "code", "state", "name").withColumn("key", folded(F.col("name")))
    asked = asked.withColumn("by_state", F.when(~one_code, F.col("state"))).withColumn("by_key", F.when(~one_code, F.col("key")))
    places = catalogue.select("kind", F.col("code").alias("c"), F.col("state").alias("s"), F.col("name").alias("full"), folded(F.col("name")).alias("k")).distinct()
    # what a code or a name answers is summed up before it is asked for: a row a code and a row a name, however many places share it
    answers = (F.count("*").alias("answers"), F.min(F.struct("c", "full", "k")).alias("place"))
    by_code = places.where("c is not null").groupBy("kind", "c").agg(*answers).select(F.col("kind").alias("of_kind"), F.col("c").alias("of_code"), F.lit(None).cast(places.schema["s"].dataType).alias("of_state"), F.lit(None).cast("string").alias("of_key"), "answers", "place")
    by_name = places.where("k is not null").groupBy("kind", "s", "k").agg(*answers).select("kind", F.lit(None).cast(places.schema["c"].dataType), "s", "k", "answers", "place")
    same = F.expr("kind = of_kind and code <=> of_code and by_state <=> of_state and by_key <=> of_key")
    told = asked.join(by_code.union(by_name), same, "left")
    other = F.col("key").isNotNull() & (F.col("key") != "") & (F.col("key") != F.col("place.k"))
    status = F.when(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False)), "unknown kind").when(F.col("answers").isNull(), "not found").when(F.col("answers") > 1, "ambiguous").when(other, "name conflict").otherwise("matched")
    matched = F.col("status") == "matched"
    told = told.select("request", "kind", status.alias("status"), F.col("place.c").alias("c"), F.col("place.full").alias("full"))
    told = told.select("request", "kind", "status", *[F.when(matched, F.col(x)).alias(x) for x in ("c", "full")])
    # a place is claimed by its first matched request; the others are dealt out by their own numbers
    claim = Window.partitionBy("kind", "c", F.when(~matched, F.col("request"))).orderBy("request")
    late = matched & (F.row_number().over(claim) > 1)
    return told.select("request", F.when(late, "duplicate").otherwise(F.col("status")).alias("status"), "kind", F.col("c").alias("code"), F.col("full").alias("name"))


def co_members(memberships: DataFrame) -> DataFrame:
    """territory, region, members (sorted): all members of every region that the territory lies in.

    ``memberships``: region, territory; a row given twice counts once.  The table meets itself on the region, so work is regions times members squared.
    """
    rows = memberships.where("region is not null and territory is not null").select("region", "territory").distinct()
    members = rows.groupBy("region").agg(F.sort_array(F.collect_set("territory")).alias("members"))
    return rows.join(members, "region").select("territory", "region", "members")


def yearly_by_cut(rows: DataFrame, memberships: DataFrame, states: DataFrame) -> DataFrame:
    """kind, cut, month, n, cents and their growth over twelve months, of territories, regions and states in one grouped pass.

    ``rows``: territory, month, n, cents.  A region is left out of a month unless every member has a value then and twelve months before; a
    state (``states``: territory, state) is the sum of those that report.
    """
    from .text_and_audit import yearly_growth

    members = memberships.where("region is not null").select("region", "territory").distinct()
    sizes = members.groupBy("region").agg(F.count("*").alias("need"))
    cuts = members.join(sizes, "region").select("territory", F.lit("region").alias("kind"), F.col("region").alias("cut"), "need")
    cuts = cuts.union(states.select("territory", F.lit("state"), "state", F.lit(1).cast("long")))
    own = rows.select("territory").distinct().select("territory", F.lit("territory"), "territory", F.lit(1).cast("long"))
    summed = rows.join(cuts.union(own), "territory").groupBy("kind", "cut", "month", "need").agg(F.count("*").alias("have"), F.sum("n").alias("n"), F.sum("cents").alias("cents"))
    whole = summed.where("kind <> 'region' or have = need").select("kind", "cut", "month", "n", "cents")
    return yearly_growth(whole, "kind", "cut").select("kind", "cut", "month", "n", "cents", F.round(F.col("cents") / 1e8, 1).alias("millions"), "growth_n", "growth_value")


def relative_to(cuts: DataFrame, states: DataFrame) -> DataFrame:
    """territory, month, points: a territory's growth less its state's, where both are told."""
    own = cuts.where("kind = 'territory'").select(F.col("cut").alias("territory"), "month", F.col("growth_n").alias("own"))
    whole = cuts.where("kind = 'state'").select(F.col("cut").alias("state"), "month", F.col("growth_n").alias("whole"))
    return own.join(states.select("territory", "state"), "territory").join(whole, ["state", "month"]).select("territory", "month", F.round(F.col("own") - F.col("whole"), 2).alias("points"))
