"""Known answers of anchors, content states, thousands and trajectories."""

from pyspark.sql import functions as F

from tidegauge.operators import anchor, editions, grounding, text_and_audit


def test_thousands_keep_years(spark):
    given = {"foram 80317 em 2024": "foram 80.317 em 2024", "R$ 4070,55": "R$ 4.070,55", "R$ 2001 e R$2002": "R$ 2.001 e R$2.002", "9876543210": "9.876.543.210", "K70000 e 70.000": "K70000 e 70.000"}
    given |= {"2050,5 ou 00012345.": "2.050,5 ou 12.345.", "12ab 1234ab 999": "12ab 1234ab 999", "": "", None: None}
    rows = spark.createDataFrame([(t,) for t in given], "t string").select("t", editions.thousands(F.col("t")).alias("out")).collect()
    assert {r["t"]: r["out"] for r in rows} == given


def test_numbers_of_a_text(spark):
    text = "F19 caiu 12,5 e 1.234 mil (−3) de 2020-2025; 7mil, 1.2345, CNAE 82, 18 anos a 24 anos: 40."
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = [(r["token"], r["value"], r["thousands"]) for r in grounding.numbers(docs, ["18 a 24"]).orderBy("place").collect()]
    assert got == [("12,5", 12.5, False), ("1.234", 1234.0, True), ("−3", -3.0, False), ("2020", 2020.0, False), ("2025", 2025.0, False), ("1", 1.0, False), ("82", 82.0, False), ("40", 40.0, False)]
    facts = spark.createDataFrame([(82,), (1234049,)], "value long")
    left = {r["token"] for r in text_and_audit.ungrounded_counts(grounding.numbers(docs, ["18 a 24"]), facts).collect()}
    assert left == {"12,5", "40"}


def test_style_and_identity(spark):
    texts = ["Cabe destacar o cenário – alta de 5% e 5,12% e 1,5 %, saldo de -83 (−4) em 2020-2025", "ACME S.A. e Beta LTDA, CNPJ; MEI, ME.", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {(r["doc_id"], r["rule"], r["n"]) for r in grounding.style(docs).collect()} == {(0, "dash", 1), (0, "phrase", 2), (0, "percent", 2), (0, "minus", 2)}
    assert [(r["place"], r["found"]) for r in grounding.identity(docs).orderBy("place").collect()] == [(0, "S.A."), (1, "LTDA"), (2, "CNPJ"), (3, "ME")]


def test_content_states(spark):
    loads = spark.createDataFrame([("x", 1, 1, None), ("x", 2, 2, "a"), ("x", 3, 3, None), ("x", 4, 4, "a"), ("x", 5, 5, "b")], "source string, at long, entry long, content string")
    assert [r["state"] for r in anchor.content_change(loads).orderBy("entry").collect()] == ["unavailable", "loaded", "unavailable", "same", "changed"]


def test_snapshot_counts_only_files_known_then(spark):
    anchors = spark.createDataFrame([("x", "g", 10, 202003, 202005)], "territory string, grouping string, stock long, anchor_month long, known_until long")
    panel = spark.createDataFrame([("x", "g", 202004, 10, 202007)], "territory string, grouping string, month long, panel_stock long, panel_known_until long")
    effects = [("x", "g", 202004, 202004, "MOV", 1), ("x", "g", 202003, 202003, "MOV", 50), ("x", "g", 202002, 202005, "FOR", 7), ("x", "g", 202002, 202006, "FOR", 2), ("x", "g", 202002, 202008, "FOR", 9)]
    rows = anchor.snapshot_difference(panel, anchors, spark.createDataFrame(effects, "territory string, grouping string, month long, file_month long, feed string, effect long")).collect()
    assert [(r["rebuilt"], r["difference"]) for r in rows] == [(13, 3)]


def test_later_months_stop_at_a_gap(spark):
    rows = spark.createDataFrame([("x", m, 1.0, 1.0) for m in (202001, 202003, 202004, 202005, 202007)], "territory string, month long, growth_n double, growth_value double")
    got = editions.trajectory(rows).where("month = 202004").orderBy("other").collect()
    assert [(r["other"], r["side"]) for r in got] == [(202001, "earlier"), (202003, "earlier"), (202005, "later")]


def test_missing_probability_is_no_hit_of_a_true_claim(spark):
    rows = spark.createDataFrame([("f", 0.9, True), ("f", None, True), ("f", None, False)], "family string, p double, truth boolean")
    assert list(editions.hits_by_family(rows).first()) == ["f", 3, 2]
