"""Known answers on small inputs."""

import os

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import months
from tidegauge.functions.classify import check_digit, percent
from tidegauge.operators import checks, facts, marts
from tidegauge.operators.text_and_audit import ledger_runs, sweep

EVENT = "state long, municipality long, grouping string, month long, file_month long, feed string, sign long"


def events(spark, rows):
    return spark.createDataFrame([(28, 280480, g, m, m, f, s) for g, m, f, s in rows], EVENT)


def places(spark):
    return spark.createDataFrame([("280480", True), ("28", True), ("280030", False)], "territory string, active boolean")


def test_exclusion_lowers_the_level_from_its_month_on(spark):
    e = events(spark, [("Comércio", 202003, "MOV", 1), ("Comércio", 202004, "MOV", 1), ("Comércio", 202004, "MOV", 1), ("Comércio", 202004, "EXC", 1)])
    ref = spark.createDataFrame([("280480", "28", "Comércio", 101)], "municipality string, state string, grouping string, stock long")
    rows = marts.stock(e, places(spark), ref, 202004, 202001).where("territory = '280480' and grouping = 'Comércio'").orderBy("month").collect()
    assert [(r["month"], r["stock"]) for r in rows] == [(202001, 99), (202002, 99), (202003, 100), (202004, 101)]


def test_state_sums_all_towns_and_no_reference_is_null(spark):
    e = spark.createDataFrame([(28, 280480, "Comércio", 202001, 202001, "MOV", 1), (28, 280030, "Comércio", 202001, 202001, "MOV", 1)], EVENT)
    ref = spark.createDataFrame([("280030", "28", "Comércio", 10)], "municipality string, state string, grouping string, stock long")
    rows = {(r["territory"], r["grouping"]): (r["net"], r["stock"]) for r in marts.stock(e, places(spark), ref, 202001).collect()}
    assert rows["28", "Comércio"] == (2, 10) and rows["280480", "Comércio"] == (1, None)


def test_reference_ahead_of_data_gives_no_level(spark):
    e = events(spark, [("Comércio", 202001, "MOV", 1)])
    ref = spark.createDataFrame([("280480", "28", "Comércio", 10)], "municipality string, state string, grouping string, stock long")
    assert marts.stock(e, places(spark), ref, 202412).where("stock is not null").count() == 0


def test_months_and_codes(spark):
    row = spark.range(1).select(*[months.shift(F.lit(m), k).alias(f"m{i}") for i, (m, k) in enumerate([(202601, -1), (202607, -12), (202512, 1)])], months.distance(F.lit(202507), F.lit(202607)).alias("d"), check_digit(F.lit(280480)).alias("a"), check_digit(F.lit(280030)).alias("b"), percent(F.lit(5184) - 4258, F.lit(4258)).alias("p")).first()
    assert list(row) == [202512, 202507, 202601, 12, 2804805, 2800308, 21.75]


def test_season_band(spark):
    past = [(202101, 10), (202201, 20), (202301, 30)]
    for net, place in ((50, "above"), (20, "inside"), (-5, "below")):
        rows = spark.createDataFrame([("x", "g", m, n) for m, n in [*past, (202401, net)]], "territory string, grouping string, month long, net long")
        assert facts.seasonality(rows).where("month = 202401").first()["position"] == place


def test_threshold_is_the_middle_of_ties(spark):
    rows = spark.createDataFrame([(0.9, True), (0.55, True), (0.6, False), (0.2, False)], "p double, truth boolean")
    best = sweep(rows).where("best").first()
    assert (round(best["threshold"], 1), best["cost"]) == (0.8, 1)


def test_open_run_commits_its_reserve(spark):
    rows = [(1, "reserve", 1, 1, 44), (1, "call", 2, 2, 5), (2, "reserve", 1, 3, 44), (2, "call", 2, 4, 5), (2, "close", 3, 5, 0)]
    got = {r["run"]: r["committed"] for r in ledger_runs(spark.createDataFrame(rows, "run long, kind string, at long, entry long, cents long")).collect()}
    assert got == {1: 44, 2: 5}


def test_checks_find_what_is_broken(spark):
    rows = spark.createDataFrame([("x", "g", 202001, 1, 5), ("x", "g", 202002, 1, 9), ("x", "g", 202002, 1, 9)], "territory string, grouping string, month long, net long, stock long")
    assert checks.repeated(rows, "territory", "grouping", "month").count() == 1
    assert checks.stock_coherent(rows.dropDuplicates()).first()["moved"] == 4
    counts = spark.createDataFrame([("a", 202001 + i, n) for i, n in enumerate([10, 10, 12, 2])], "k string, month long, n long")
    assert [r["month"] for r in checks.volume_anomaly(counts, "k").collect()] == [202004]


def test_drilldown_prefers_subgroupings_and_counts_the_unidentified(spark):
    flow = spark.createDataFrame(
        [("t", 202401, "Serviços", "a", "60", "x", 6, 0, 6), ("t", 202401, "Serviços", "b", "NI", None, 1, 1, 0), ("t", 202301, "Serviços", "a", "60", "x", 1, 0, 1),
         ("t", 202401, "Comércio", "c", "45", "y", 5, 0, 5), ("t", 202401, "Comércio", "c", "46", "z", 0, 1, -1),
         ("t", 202401, "Construção", "d", "41", "w", 9, 0, 9)],
        "territory string, month long, grouping string, subgrouping string, division string, description string, admissions long, separations long, net long",
    )
    chosen = spark.createDataFrame([("t", "Serviços", 202401, 6), ("t", "Comércio", 202401, 4), ("t", "Construção", 202401, 9)], "territory string, grouping string, month long, net long")
    got = [(r["grouping"], r["level"], r["code"], r["net"], r["net_of_rest"], r["net_year_ago"], r["share"], r["rank"]) for r in facts.drilldown(flow, chosen).orderBy("rank").collect()]
    assert got == [("Serviços", "subgrouping", "a", 6, 0, 1, 75.0, 1), ("Comércio", "division", "45", 5, -1, 0, 83.33, 2)]


def test_highlights_leave_the_rest(spark):
    rows = [("t", "Serviços", 202401, 9, "inside"), ("t", "Comércio", 202401, -7, "inside"), ("t", "Indústria", 202401, 4, "above"), ("t", "Construção", 202401, 3, "inside"), ("t", "Não Identificado", 202401, 50, "above")]
    season = spark.createDataFrame(rows, "territory string, grouping string, month long, net long, position string")
    got = facts.highlights(season).collect()
    assert {r["grouping"]: r["rank"] for r in got} == {"Serviços": 1, "Comércio": 2, "Indústria": 3} and {r["rest"] for r in got} == {53}


def test_profiles_are_relevant_by_balance_or_by_change(spark):
    rows = [("t", 202301, "sex", "Homem", 50, 0, 50), ("t", 202301, "sex", "Mulher", 50, 0, 50)]
    rows += [("t", 202401, "sex", "Homem", 60, 55, 5), ("t", 202401, "sex", "Mulher", 29, 0, 29), ("t", 202401, "sex", "Não Identificado", 31, 0, 31)]
    got = facts.profile_share(spark.createDataFrame(rows, "territory string, month long, dimension string, category string, admissions long, separations long, net long")).where("month = 202401")
    assert {r["category"]: (r["small_base"], r["unidentified"], r["relevant"]) for r in got.collect()} == {"Homem": (False, False, False), "Mulher": (True, False, False), "Não Identificado": (False, True, False)}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the given tables")
def test_lines_are_placed_where_they_are(spark, tmp_path):
    from tidegauge.plans import audits
    from tidegauge.sources import tables

    for name in ("nation", "lineitem"):
        os.symlink(f"/root/testdata/sf0.1/{name}.parquet", tmp_path / f"{name}.parquet")
    spark.range(20000).selectExpr("id s_suppkey", "concat('Supplier ', id) s_name", "cast(id % 25 as int) s_nationkey", "rand(1) s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    for rows in (tables.events(spark, str(tmp_path)), audits.raw_events(spark, str(tmp_path))):
        plan = rows._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


def test_wages_stay_where_they_are_but_for_the_slots_asked_for(spark):
    def moved(plan):
        """The most rows that a shuffle of the plan moved."""
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return moved(plan.executedPlan())
        if "QueryStage" in name:
            return moved(plan.plan())
        own = plan.metrics().apply("shuffleRecordsWritten").value() if name == "Exchange" else 0
        return max([own, *(moved(plan.children().apply(k)) for k in range(plan.children().size()))])

    counts = spark.range(1, 20001).selectExpr("280010L municipality", "28L state", "202601L month", "if(id % 2 = 0, 'a', 'b') grouping", "cast(id as double) wage", "1L n")
    places = spark.createDataFrame([("280010", "municipality", None, True), ("28", "state", None, True)], "territory string, kind string, region string, active boolean")
    got = marts.hiring_wage(counts, places).select("territory", "month", "n_wages", "median_wage", "mean_wage")
    assert sorted(map(tuple, got.collect())) == [("28", 202601, 20000, 10000.0, 10000.5), ("280010", 202601, 20000, 10000.0, 10000.5)]
    assert 0 < moved(got._jdf.queryExecution().executedPlan()) < 10000


def test_wages_are_not_moved_to_be_counted(spark):
    columns = "municipality long, state long, month long, grouping string, feed string, sign long, wage_unit int, wage double"
    hires = [(280010, 28, 202601, "a", "MOV", 1, 5, w) for w in [1000.0] * 5 + [1500.0, 1500.0, 2000.0]]
    others = [(280010, 28, 202601, "a", f, s, u, w) for f, s, u, w in [("FOR", 1, 5, 9.0), ("MOV", -1, 5, 9.0), ("MOV", 1, 1, 9.0), ("MOV", 1, 5, 0.0), ("MOV", 1, 5, None)]]
    counts = marts.wage_counts(spark.createDataFrame(hires + others, columns))
    assert "Exchange" not in counts._jdf.queryExecution().sparkPlan().toString() and "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    places = spark.createDataFrame([("280010", "municipality", None, True), ("28", "state", None, True)], "territory string, kind string, region string, active boolean")
    got = marts.hiring_wage(counts, places).select("territory", "n_wages", "median_wage", "mean_wage").collect()
    assert sorted(map(tuple, got)) == [("28", 8, 1000.0, 1250.0), ("280010", 8, 1000.0, 1250.0)]
    palma = marts.wage_summary(counts, "municipality").first()["palma"]
    assert palma == 2.0  # the wages from p90 on: 2000; up to p40: 1000


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
def test_marts_do_not_wait_for_the_staging_table(spark):
    from tidegauge.plans import registry
    from tidegauge.sources import store

    sf = "/root/testdata/sf0.001"
    store.forget(sf)
    told = {n: registry.QUERIES[n](spark, sf).count() for n in ("fact_tables", "dq_wage_range", "dq_grain_marts")}
    assert not store.is_built(spark, sf, "events")
    store.forget(sf)
    registry.QUERIES["stg_events"](spark, sf)
    assert store.is_built(spark, sf, "events") and {n: registry.QUERIES[n](spark, sf).count() for n in told} == told


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the given tables")
def test_suppliers_are_sent_under_any_threshold(spark):
    from tidegauge.plans import audits
    from tidegauge.sources import tables

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        for rows in (tables.events(spark, "/root/testdata/sf0.01"), audits.raw_events(spark, "/root/testdata/sf0.01")):
            plan = rows._jdf.queryExecution().sparkPlan().toString()
            assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
