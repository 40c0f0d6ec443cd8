"""Rules, residuals, mapped names, months of spend and typed scans on small inputs, with errors."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegauge.functions.classify import section_of_code, subclass_code
from tidegauge.operators import checks
from tidegauge.operators import text_and_audit as A
from tidegauge.sources import feeds


def test_subclasses_given_as_text(spark):
    rows = spark.createDataFrame([("111302",), ("2424502",), ("9900800",), ("9999999",), (None,), (" 4711301 ",), ("400000",)], "raw string")
    got = [tuple(r) for r in rows.select(subclass_code(F.col("raw")).alias("c")).select("c", section_of_code(F.col("c"))).collect()]
    assert got == [("0111302", "A"), ("2424502", "C"), ("9900800", "U"), ("9999999", "Z"), (None, "Z"), ("4711301", "G"), ("0400000", "Z")]


def test_unique_and_related(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, v long")
    dimension = spark.createDataFrame([("b",), (None,)], "key string")
    told = checks.named_rules({"unique": checks.not_unique(rows, "k", "v"), "related": checks.unrelated(rows, "k", dimension, "key"), "none": checks.not_unique(rows.where("false"), "k")})
    assert {r["rule"]: r["violations"] for r in told.collect()} == {"unique": 2, "related": 3, "none": 0}


def test_residuals_names_and_totals(spark):
    rows = spark.createDataFrame([(1, "TOTAL", 10), (1, "a", 3), (1, "b", 4), (2, "TOTAL", 10), (2, "a", 3), (2, "b", 4), (3, "TOTAL", 5), (3, "a", 1), (4, "TOTAL", 7), (4, "a", 3), (4, "b", 4)], "month long, grouping string, net long")
    given = spark.createDataFrame([(1, 3), (2, 2), (3, 9)], "month long, net long")
    got = {r["month"]: (r["residual"], r["status"]) for r in A.residual_status(rows, given, "TOTAL", ["a", "b"]).collect()}
    assert got == {1: (3, "agrees"), 2: (3, "differs"), 3: (None, "incomplete"), 4: (0, "derived")}
    with pytest.raises(ValueError, match="a"):
        A.renamed(rows, {"A": "a", "AA": "a"})
    assert {r["grouping"] for r in A.renamed(rows, {"a": "Á", "b": "B"}).collect()} == {"TOTAL", "Á", "B"}
    more = A.with_totals(rows.where("grouping <> 'TOTAL' or month = 1"), ["net"]).where("grouping = 'TOTAL'")
    assert {r["month"]: r["net"] for r in more.collect()} == {1: 10, 2: 7, 3: 1, 4: 7}


def test_spend_by_month(spark):
    at = lambda m, d: dt.datetime(2026, m, d)
    rows = [(1, "reserve", at(1, 1), 1, 50), (1, "call", at(1, 2), 2, 8), (1, "call", at(2, 1), 3, 9), (1, "close", at(2, 2), 4, 0), (2, "reserve", at(2, 1), 5, 30)]
    got = A.ledger_months(spark.createDataFrame(rows, "run long, kind string, at timestamp, entry long, cents long")).collect()
    assert {r["month"]: (r["runs"], r["committed"]) for r in got} == {202601: (1, 50), 202602: (2, 39)}


def test_scans_of_one_month_of_seeds_and_of_rates(spark, tmp_path):
    rows = spark.createDataFrame([("01", "MOV", 202001), ("02", "MOV", 202002), ("03", "EXC", 202001)], "code string, feed string, file_month long")
    path = str(tmp_path / "feeds")
    rows.write.partitionBy("feed", "file_month").option("sep", ";").option("header", True).csv(path)
    one = feeds.pinned_scan(spark, path, "MOV", 202002)
    assert [tuple(r) for r in one.select("code", "feed", "file_month").collect()] == [("02", "MOV", "202002")] and len(one.inputFiles()) == 1
    assert feeds.pinned_scan(spark, path, "MOV").count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        feeds.pinned_scan(spark, path, "FOR")
    (tmp_path / "seed.csv").write_text("territory,active\n28,true\n2804,false\n")
    assert [tuple(r) for r in feeds.seed_scan(spark, str(tmp_path / "seed.csv"), "territory string, active boolean").collect()] == [("28", True), ("2804", False)]
    for schema in ("active boolean, territory string", "territory string, active long"):
        with pytest.raises(Exception):
            feeds.seed_scan(spark, str(tmp_path / "seed.csv"), schema).collect()
    (tmp_path / "rate.json").write_text('{"data": "31/12/2025", "valor": "14.75"}\n{"data": "02/01/2026", "valor": "15"}\n')
    assert [tuple(r) for r in feeds.rate_scan(spark, str(tmp_path / "rate.json")).collect()] == [(dt.date(2025, 12, 31), 14.75), (dt.date(2026, 1, 2), 15.0)]


def test_staging_is_compiled_in_small_methods_and_not_written_first(spark):
    from tidegauge.plans import audits
    from tidegauge.sources import store

    sf = "/root/testdata/sf0.001"
    staged = audits.QUERIES["stg_events_full"](spark, sf)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"  # beyond it HotSpot interprets a method
    assert not any(name == "stg_events_full" for _, _, name in store._BUILT)  # nothing else reads it
    assert staged.count() == spark.read.parquet(f"{sf}/lineitem.parquet").count()
