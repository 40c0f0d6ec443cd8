"""Registries, hashes, grounding by unit, the store of editions, the reconciling stream and the fitted smoothing."""

import os
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import editions, grounding, published
from tidegauge.operators import forecast as P
from tidegauge.sources import editions as store
from tidegauge.streaming import ingest

FACTS = [("panorama.net", 1234.0, "people"), ("panorama.rate_month", 12.345, "percent"), ("panorama.stock", 80317.0, "people"), ("wage.median_wage", 1412.5, "money"), ("profile.share", None, "percent")]
LABELS = ["18 a 24", "65 ou mais", "até 17"]


def judge(spark, text, labels=LABELS, facts=FACTS):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    table = spark.createDataFrame(facts, "id string, value double, unit string")
    tokens = grounding.numbers(docs, labels)
    bad = {r["token"] for r in grounding.ungrounded(tokens, table).collect()}
    only = {r["token"] for r in grounding.only_in_tables(tokens, table, [("panorama", ("net", "rate_month")), ("wage", ())]).collect()}
    return bad, only


@pytest.mark.parametrize(
    "text,bad,only",
    [
        ("alta de 12%, 12,3% e 12,35%, não 12,4%", {"12,4"}, set()),
        ("R$ 1.412,50 ou R$ 1.413, não R$ 1.412,5 nem 1412", {"1412"}, set()),
        ("saldo de 1.234 (1234, −1.234), 1,2 mil, 1 mil, não 1,3 mil nem 1.235", {"1,3", "1.235"}, set()),
        ("estoque de 80.317, 80,3 mil, 80 mil ou 80,317 mil", set(), {"80.317", "80,3", "80", "80,317"}),
        ("de 18 a 24 anos, 18 anos a 24 anos, 65 ou mais, Até  17. Mas 18 e 24, 118 a 24", {"18", "24", "118"}, set()),
        ("em 2026, 12 casos, 13 não", {"13"}, set()),
        ("F19, 7mil, 1.2345, 1,5a, CNAE 82; 12.34, x_5 5_x 3-4", {"82"}, set()),
        ("", set(), set()),
        (None, set(), set()),
    ],
)
def test_numbers_against_facts_by_unit(spark, text, bad, only):
    assert judge(spark, text) == (bad, only)


def test_facts_of_another_scope_bear_nothing_out(spark):
    docs = spark.createDataFrame([("a", "saldo 55"), ("b", "saldo 55")], "territory string, text string")
    facts = spark.createDataFrame([("a", "panorama.net", 55.0, "people")], "territory string, id string, value double, unit string")
    tokens = grounding.numbers(docs, (), ("territory",))
    assert [r["territory"] for r in grounding.ungrounded(tokens, facts, "territory").collect()] == ["b"]


def test_hash_is_canonical_and_ids_are_unique(spark):
    rows = [("x", 1, f"id{i}", i + 0.1234, None if i % 3 else "people") for i in range(50)]
    schema = "territory string, month long, id string, value double, unit string"
    a = spark.createDataFrame(rows, schema).repartition(5)
    b = spark.createDataFrame([(*r[:3], r[3] + 1e-9, r[4]) for r in reversed(rows)], schema).select("unit", "value", "id", "month", "territory").repartition(2)
    c = spark.createDataFrame([(*r[:3], r[3] + 0.01, r[4]) for r in rows], schema)
    h = lambda df: published.content_hash(df, ["territory", "month"]).first()["hash"]
    assert h(a) == h(b) != h(c)
    assert h(a) != h(a.withColumn("unit", F.coalesce("unit", F.lit("")))) and published.unique(a, "territory", "id").count() == 50
    with pytest.raises(ValueError, match="id7"):
        published.unique(a.union(a.where("id = 'id7'")), "territory", "month", "id")


def test_editions_outlive_runs(spark, tmp_path):
    path = str(tmp_path / "editions")
    cols = "territory string, edition long, month long, admissions double, separations double, net double, level double, low double, high double"
    make = lambda rows: spark.createDataFrame([(t, e, m, 1.0, 1.0, 0.0, float(v), None, None) for t, e, m, v in rows], cols)
    now = spark.createDataFrame([("a", 202603), ("b", 202603), ("c", 202603)], "territory string, edition long")
    assert store.last_before(store.read(spark, path), now).count() == 0
    store.save(make([("a", 202601, 202603, 10), ("a", 202601, 202604, 11), ("b", 202601, 202603, 20)]), path)
    store.save(make([("a", 202602, 202603, 12), ("a", 202603, 202604, 99)]), path)
    store.save(make([("a", 202601, 202605, 13)]), path)  # the edition is replaced as a whole, others of the month stay
    got = sorted((r["territory"], r["edition"], r["month"], r["level"]) for r in store.read(spark, path).collect())
    assert got == [("a", 202601, 202605, 13), ("a", 202602, 202603, 12), ("a", 202603, 202604, 99), ("b", 202601, 202603, 20)]
    assert sorted((r["territory"], r["level"]) for r in store.last_before(store.read(spark, path), now).collect()) == [("a", 12), ("b", 20)]
    rows = spark.createDataFrame([(t, 202603, 5) for t in "abc"], "territory string, month long, level long")
    again = spark.createDataFrame([(t, 202603, 7) for t in "abc"], "territory string, month long, level long")
    told = {r["territory"]: (r["level"], r["origin"]) for r in editions.previous_editions(rows, store.read(spark, path), again).collect()}
    assert told == {"a": (12, "stored"), "b": (20, "stored"), "c": (7, "recomputed")}


def test_the_reconciling_stream_keeps_what_a_table_would_say(spark, tmp_path):
    folders = [tmp_path / f for f in ("mov", "for", "exc")]
    for f in folders:
        f.mkdir()
    state, registry, checkpoint = (str(tmp_path / x) for x in ("state", "registry", "cp"))
    put = lambda k, name, rows: (folders[k] / name).write_text("month;grouping;sign\n" + "".join(f"{m};{g};{s}\n" for m, g, s in rows))
    run = lambda: ingest.reconcile_feeds(spark, [str(f) for f in folders], "month long, grouping string, sign long", state, registry, checkpoint).awaitTermination()

    def same():
        files = spark.read.schema("month long, grouping string, sign long").option("sep", ";").option("header", True).csv([str(f) for f in folders])
        files = ingest.with_load_key(files.select("*", F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_size").alias("bytes")))
        want = ingest.kept(files)
        flows = [tuple(r) for r in want.where("kind = 'flow'").select("month", "name", "admissions", "separations", "net", "rows").collect()]
        names = [tuple(r) for r in want.where("kind = 'file'").select("feed", "month", "name", "rows", "bytes", "digest").collect()]
        read = lambda p, *c: sorted(tuple(r) for r in spark.read.parquet(p).select(*c).collect())
        assert read(state, "month", "grouping", "admissions", "separations", "net", "rows") == sorted(flows)
        assert read(registry, "feed", "file_month", "file_name", "rows", "bytes", "digest") == sorted(names)
        return sorted(flows)

    put(0, "MOV202001.txt", [(202001, "a", 1), (202001, "a", 1), (202001, "b", -1)])
    run()
    assert same() == [(202001, "a", 2, 0, 2, 2), (202001, "b", 0, 1, -1, 1)]
    put(2, "EXC202002.txt", [(202001, "a", 1)])
    put(1, "FOR202002.txt", [(202001, "c", 1), (202001, "b", 1)])
    run()
    first = same()
    assert first == [(202001, "a", 1, 0, 1, 3), (202001, "b", 1, 1, 0, 2), (202001, "c", 1, 0, 1, 1)]
    commits = tmp_path / "cp" / "commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for f in (commits / str(last), commits / f".{last}.crc"):
        f.unlink(missing_ok=True)
    run()  # the last batch once more
    assert same() == first
    put(0, "MOV202003.txt", [(202003, "a", 1)])
    run()
    assert len(same()) == 4


def test_smoothing_is_fitted_no_worse_than_by_a_fine_grid():
    rng, axis = np.random.default_rng(11), np.linspace(1e-4, 0.9999, 8)
    grid = np.array(list(product(axis, axis, axis, np.linspace(0.8, 0.98, 4))))
    for _ in range(20):
        n = int(rng.integers(30, 85))
        t = np.arange(n)
        y = np.exp(3 + 0.01 * t * rng.normal() + 0.4 * np.sin(t / 1.9) + rng.normal(0, 0.3, n).cumsum() * rng.choice([0, 0.3]) + rng.normal(0, 0.2, n))
        z = np.log(np.maximum(y, 0.5))
        assert P._smoothed(y, [len(y)], 1)[1][0] <= min(P._fitted(z, grid[i : i + 256])[0].min() for i in range(0, len(grid), 256)) * (1 + 1e-9)
    season = np.exp(4 + np.tile(np.arange(12) / 10, 5))
    assert np.allclose(P._smoothed(season[:48], [48], 12)[0][0], season[48:], rtol=0.01)
