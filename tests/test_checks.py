"""Every check finds what is broken and leaves what isn't."""

from pyspark.sql import functions as F

from tidegauge.functions.classify import UNIDENTIFIED, subgrouping_of
from tidegauge.operators import checks as C
from tidegauge.operators import marts
from tidegauge.plans import analyses
from tidegauge.sources import store

LEVEL = "territory string, grouping string, month long, net long, stock long"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_levels(spark):
    good = [("a", "x", 202001, 2, 10), ("a", "x", 202002, 3, 13), ("b", "x", 202001, 1, None)]
    df = spark.createDataFrame(good + [("c", "x", 202001, 0, 5), ("c", "x", 202002, 2, 8), ("c", UNIDENTIFIED, 202001, 0, -1), ("c", "y", 202001, 0, -2)], LEVEL)
    assert rows(C.stock_coherent(df)) == [("c", "x", 202002, 2, 3)] and C.stock_coherent(df.where("territory <> 'c'")).count() == 0
    assert rows(C.negative(df, True)) == [("c", UNIDENTIFIED, 202001, -1)] and rows(C.negative(df, False)) == [("c", "y", 202001, -2)]
    reference = spark.createDataFrame([("a", "x", 10), ("c", "x", 4)], "territory string, grouping string, reference long")
    assert {(r["territory"], r["grouping"]) for r in C.stock_matches_reference(df, reference, 202001).collect()} == {("c", "x"), ("c", UNIDENTIFIED), ("c", "y")}


def test_sums_by_key(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4), ("d", 0)], "k string, net long")
    right = spark.createDataFrame([("a", 3), ("b", 5), ("c", 1)], "k string, net long")
    assert rows(C.same_net(left, right, ["k"], ["net"])) == [("b", 4, 5), ("c", 0, 1)]
    parts = spark.createDataFrame([("sex", "a", 3), ("sex", "b", 5), ("sex", "c", 1), ("age", "a", 3), ("age", "b", 4), ("age", "c", 1)], "dimension string, k string, net long")
    assert [(r["k"], r["dimension"]) for r in C.same_by(parts, "dimension", ["sex", "age"], right, ["k"], ["net"]).collect()] == [("b", "age")]


def test_months_signs_grains_and_wages(spark):
    seen = spark.createDataFrame([("a", 201911), ("a", 202001), ("b", 201911), ("b", 201912), ("b", 202001)], "k string, month long")
    assert rows(C.missing_months(seen, "k", "month")) == [("a", 201912)]
    events = spark.createDataFrame([("MOV", 10, 1), ("MOV", 31, -1), ("MOV", 99, 1), ("MOV", 99, -1), ("EXC", 10, 1), ("EXC", 31, 1), ("EXC", 99, 1)], "feed string, movement_type long, sign long")
    assert rows(C.exclusion_sign(events)) == [(31, 1)]
    once, twice = (spark.createDataFrame([("a", 1)] * n, "k string, v long") for n in (1, 2))
    assert rows(C.repeated_in({"once": (once, ["k"]), "twice": (twice, ["k", "v"])})) == [("twice", 2)]
    wages = spark.createDataFrame([("a", 1, 700.0, 900.0), ("a", 2, 400.0, 900.0), ("a", 3, 700.0, 9000.0)], "territory string, month long, median_wage double, mean_wage double")
    assert [r[1] for r in rows(C.wage_range(wages))] == [2, 3]
    monthly = spark.createDataFrame([(1, "x", 9, 100.0, 110.0), (2, "x", 9, 100.0, 130.0), (3, "x", 2, 100.0, 200.0)], "month long, grouping string, n_wages long, median_wage double, mean_wage double")
    assert [r[0] for r in rows(C.mean_vs_median(monthly))] == [2]


def test_summary_tells_every_check(spark):
    one, none = spark.range(1), spark.range(0)
    got = {r["check"]: (r["violations"], r["status"]) for r in C.summary({"a": ("error", one), "b": ("warn", one), "c": ("error", none)}).collect()}
    assert got == {"a": (1, "ERROR"), "b": (1, "WARN"), "c": (0, "PASS")}
    assert len(analyses.checks()) >= 24 and analyses.WARNED <= set(analyses.checks())


def test_flows_carry_subgrouping_and_description(spark):
    sections = spark.createDataFrame([(x,) for x in "ACBFGHIJOSTZ"], "s string")
    assert len({r[0] for r in sections.select(subgrouping_of(F.col("s"))).collect()}) == 12
    events = [(28, 280480, "Serviços", "I", 202001, "MOV", 1, 5600000), (28, 280480, "Serviços", "I", 202001, "MOV", 1, 5611000), (28, 280030, "Serviços", "I", 202001, "EXC", 1, 5611000), (28, 280480, UNIDENTIFIED, "Z", 202001, "FOR", -1, 9999999)]
    e = spark.createDataFrame(events, "state long, municipality long, grouping string, section string, month long, feed string, sign long, subclass long")
    places = spark.createDataFrame([("280480", True), ("28", True), ("280030", False)], "territory string, active boolean")
    divisions = spark.createDataFrame([("56", "Alimentação")], "division string, description string")
    got = {(r["territory"], r["division"]): (r["subgrouping"], r["description"], r["admissions"], r["separations"], r["net"]) for r in marts.flow(e, places, divisions).collect()}
    assert got == {("280480", "56"): ("Alojamento e alimentação", "Alimentação", 2, 0, 2), ("28", "56"): ("Alojamento e alimentação", "Alimentação", 1, 0, 1), ("280480", "NI"): (UNIDENTIFIED, "Não identificada", 0, 1, -1), ("28", "NI"): (UNIDENTIFIED, "Não identificada", 0, 1, -1)}


def test_marts_are_built_once(spark):
    calls = []

    def make():
        calls.append(1)
        return spark.range(3)

    for _ in range(3):
        assert store.built(spark, "/nowhere", "thing", make).count() == 3
    assert len(calls) == 1
    store.forget("/nowhere")
    assert store.built(spark, "/nowhere", "thing", make).count() == 3 and len(calls) == 2
