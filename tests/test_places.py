"""Resolution of places, regions' members, indicators by cut, names, labels and lists of months on small inputs."""

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import months, style
from tidegauge.operators import entities, marts

REQUEST = "request long, kind string, code long, state long, name string"


def test_every_status_of_a_request(spark):
    places = [("municipality", 280480, 28, "Nossa Senhora do Socorro"), ("municipality", 280030, 28, "Aracaju"), ("municipality", 290001, 29, "Aracaju"), ("municipality", 280100, 28, "Bom Jesus"), ("municipality", 280101, 28, "Bom-Jesus"), ("state", 28, None, "Sergipe"), ("state", 28, None, "Sergipe")]
    asked = [
        (1, "municipality", 280480, None, "NOSSA SENHORA  do Socôrro"), (2, "municipality", None, 28, "aracajú"), (3, "municipality", 280030, None, None), (4, "municipality", 280480, None, "Aracaju"),
        (5, "municipality", None, 28, "bom jesus"), (6, "municipality", None, 28, "Lugar nenhum"), (7, "state", 28, None, None), (8, "country", 1, None, None), (9, "municipality", None, None, "Aracaju"),
        (10, "municipality", None, 29, "ARACAJU"), (11, None, None, None, None), (12, "municipality", None, None, None), (13, "state", 28, None, "Sergipe"),
    ]
    got = {r["request"]: (r["status"], r["code"]) for r in entities.resolve(spark.createDataFrame(asked, REQUEST), spark.createDataFrame(places, "kind string, code long, state long, name string")).collect()}
    want = {1: ("matched", 280480), 2: ("matched", 280030), 3: ("duplicate", 280030), 4: ("name conflict", None), 5: ("ambiguous", None), 6: ("not found", None), 7: ("matched", 28), 8: ("unknown kind", None), 9: ("not found", None), 10: ("matched", 290001), 11: ("unknown kind", None), 12: ("not found", None), 13: ("duplicate", 28)}
    assert got == want


def test_members_of_all_regions(spark):
    rows = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "a"), ("r2", "c"), ("r2", "c"), (None, "d"), ("r3", None)], "region string, territory string")
    got = {(r["territory"], r["region"]): r["members"] for r in entities.co_members(rows).collect()}
    assert got == {("a", "r1"): ["a", "b"], ("b", "r1"): ["a", "b"], ("a", "r2"): ["a", "c"], ("c", "r2"): ["a", "c"]}


def test_a_region_with_an_absent_member_is_left_out(spark):
    data = [("a", 202501, 10, 1000), ("b", 202501, 5, 500), ("a", 202601, 20, 3000), ("b", 202601, 6, 600), ("a", 202502, 1, 1), ("a", 202602, 2, 2), ("b", 202602, 2, 2)]
    rows = spark.createDataFrame(data, "territory string, month long, n long, cents long")
    members = spark.createDataFrame([("r", "a"), ("r", "b")], "region string, territory string")
    states = spark.createDataFrame([("a", "28"), ("b", "28")], "territory string, state string")
    cuts = entities.yearly_by_cut(rows, members, states)
    got = {(r["kind"], r["cut"], r["month"]): (r["n"], r["growth_n"]) for r in cuts.collect()}
    assert got[("region", "r", 202601)] == (26, 73.33) and ("region", "r", 202602) not in got
    assert got[("state", "28", 202602)] == (4, 300.0) and got[("territory", "a", 202602)] == (2, 100.0)
    assert {(r["territory"], r["month"]): r["points"] for r in entities.relative_to(cuts, states).collect()}[("a", 202601)] == 26.67


def test_labels_and_names(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert [one(style.month_label(F.lit(202607), f)) for f in ("long", "slash", "short")] == ["julho de 2026", "julho/2026", "jul/26"]
    assert [one(style.whole(F.lit(x), signed=True)) for x in (1234567, -1234, 0)] == ["+1.234.567", "−1.234", "0"]
    assert [one(style.decimals(F.lit(x))) for x in (1234.5, -0.05, 0.0, 12.345)] == ["1.234,50", "−0,05", "0,00", "12,35"]
    assert one(style.activity_name(F.lit("COMÉRCIO VAREJISTA"))) == "Comércio varejista" and one(style.activity_name(F.lit("Já Escrito"))) == "Já Escrito"
    assert [one(style.folded(F.lit(x))) for x in ("Nossa Senhora d’Água ", "--", "ŁÓDŹ é")] == ["nossa_senhora_d_agua", "", "odz_e"]


def test_lists_of_months(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(months.of_list(F.lit("202511..202602, 202601,202001"))) == [202511, 202512, 202601, 202602, 202001]
    assert one(months.of_years(F.lit(2024), F.lit(2025), F.lit(202503), [3, 12])) == [202403, 202412, 202503]
    assert one(months.last(F.lit(202601), 3)) == [202511, 202512, 202601]
    for bad in ("202613", "2026", "202602..202601", ""):
        with pytest.raises(Exception, match="not a"):
            one(months.of_list(F.lit(bad)))
    with pytest.raises(Exception, match="202602"):
        one(months.available(F.array(F.lit(202601), F.lit(202602)), F.array(F.lit(202601))))


def test_percentiles_are_selected_from_counts(spark):
    import random

    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.choice([0.01, 1.0, 1412.0, 1412.01, 1e7, rng.randint(1, 10**7) / 100])) for _ in range(3000)] + [("c", 5.0), ("d", 1.0), ("d", 2.0)]
    table = spark.createDataFrame(rows, "k string, wage double")
    counts = table.groupBy("k", "wage").agg(F.count("*").alias("n"))
    want = {r["k"]: tuple(r)[1:] for r in table.groupBy("k").agg(*[F.expr(f"percentile_disc({p / 100}) within group (order by wage)") for p in (1, 40, 50, 90, 100)]).collect()}
    assert {r["k"]: tuple(r)[1:] for r in marts.selected(counts, ["k"], [1, 40, 50, 90, 100]).collect()} == want


def test_first_level_and_own_anchors(spark):
    event = "state long, municipality long, grouping string, month long, file_month long, feed string, sign long"
    places = spark.createDataFrame([("280480", True), ("28", True)], "territory string, active boolean")
    e = spark.createDataFrame([(28, 280480, "Comércio", m, m + 1, f, 1) for m, f in ((202001, "MOV"), (202002, "MOV"), (202001, "FOR"), (202002, "FOR"))], event)
    ref = spark.createDataFrame([("280480", "28", "Comércio", 10)], "municipality string, state string, grouping string, stock long")
    rows = marts.stock(e, places, ref, 202002, first_level=202002).where("grouping = 'Comércio' and territory = '28'").orderBy("month").collect()
    assert [(r["month"], r["stock"], r["reference_month"]) for r in rows] == [(202001, None, 202002), (202002, 10, 202002)]
    anchors = spark.createDataFrame([("280480", 202001, 202001), ("28", 202002, 202002)], "territory string, anchor_month long, known_until long")
    got = {r["territory"]: (r["rows"], r["first_file"]) for r in marts.anchor_adjustment(e, places, anchors).collect()}
    assert got == {"280480": (1, 202002), "28": (1, 202003)}
    assert marts.report_source(None, marts.monthly_by_grouping(e.withColumn("wage_unit", F.lit(5)).withColumn("wage", F.lit(1.0)))).first()["source"] == "on time"


def test_shared_names_are_counted_before_requests_ask_for_them(spark):
    """Places and requests of one name give no pairs of the two: rows moved grow with the requests, not with how many places share a name."""
    places = spark.range(400).selectExpr("'municipality' kind", "id code", "28L state", "'Bom Jesus' name")
    asked = spark.range(500).selectExpr("id request", "'municipality' kind", "cast(null as long) code", "28L state", "'bom jesus' name")
    twice = spark.createDataFrame([(9, "municipality", 7, None, None), (9, "municipality", 7, None, None), (10, "municipality", 7, None, "outro")], REQUEST)
    got = entities.resolve(asked.union(twice), places)
    rows = got.groupBy("status", "code").count().collect()
    assert sorted((r["status"], r["code"], r["count"]) for r in rows if r["code"] is not None) == [("duplicate", 7, 1), ("matched", 7, 1)]
    assert {r["status"]: r["count"] for r in rows if r["code"] is None} == {"ambiguous": 500, "name conflict": 1}

    def joined(plan):
        """The most rows that a join of the plan gave."""
        name, found = plan.nodeName(), 0
        if name == "AdaptiveSparkPlan":
            return joined(plan.executedPlan())
        if "QueryStage" in name:
            return joined(plan.plan())
        if "Join" in name:
            found = plan.metrics().apply("numOutputRows").value()
        return max([found, *(joined(plan.children().apply(k)) for k in range(plan.children().size()))])

    got.collect()
    assert 0 < joined(got._jdf.queryExecution().executedPlan()) <= 503
