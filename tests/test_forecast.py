"""Forecasts of every method from every origin against numpy, bands carried on, and guards on broken forecasts."""

import numpy as np

from tidegauge.operators import forecast as P


def series(spark, n=40):
    rng = np.random.default_rng(2)
    rows, level = [], {"a": 1000, "b": 400}
    for t in range(n):
        for k in level:
            up, down = int(40 + 8 * np.sin(t) + rng.integers(0, 9)), int(36 + rng.integers(0, 9))
            level[k] += up - down
            rows.append((k, (2015 + t // 12) * 100 + t % 12 + 1, up, down, up - down, level[k]))
    return rows, spark.createDataFrame(rows, "territory string, month long, admissions long, separations long, net long, level long")


def by_hand(y, t, horizon):
    """Seasonal rates and the naive way from month ``t`` of columns (admissions, separations, level)."""
    up, down, level = y[: t + 1].T
    s, seasonal, naive, base = level[-1], [], [], level[-1]
    for k in range(1, horizon + 1):
        same = [i for i in range(1, t + 1) if (i - t - k) % 12 == 0][-3:]
        ra, rd = np.mean([up[i] / level[i - 1] for i in same]), np.mean([down[i] / level[i - 1] for i in same])
        s = s + ra * s - rd * s
        seasonal.append(s)
        at = t + k - 12 * (-(-k // 12))
        base = base + up[at] - down[at]
        naive.append(base)
    return seasonal, naive


def test_every_method_from_every_origin(spark):
    rows, df = series(spark)
    errors = {(r["method"], r["territory"], r["origin"], r["h"]): r for r in P.backtest_methods(df).collect()}
    y = np.array([r[2:4] + (r[5],) for r in rows if r[0] == "a"], dtype=float)
    month = [r[1] for r in rows if r[0] == "a"]
    assert {k[2] for k in errors if k[1] == "a"} == set(month[24:-1])
    for t in (24, 30, 38):
        horizon = min(24, len(y) - 1 - t)
        for name, said in zip(("seasonal", "naive"), by_hand(y, t, horizon)):
            got = [errors[name, "a", month[t], k + 1]["error"] for k in range(horizon)]
            assert np.allclose(got, y[t + 1 : t + 1 + horizon, 2] - said, atol=1e-3)
        smooth = y[t, 2] + np.cumsum(np.subtract(*(P._smoothed(y[: t + 1, c], [t + 1], horizon, quick=True)[0][0] for c in (0, 1))))
        assert np.allclose([errors["smooth", "a", month[t], k + 1]["error"] for k in range(horizon)], y[t + 1 : t + 1 + horizon, 2] - smooth, atol=1e-3)
        for k in range(1, horizon + 1):
            mean = np.mean([errors[m, "a", month[t], k]["error_net"] for m in ("seasonal", "smooth")])
            assert abs(errors["combined", "a", month[t], k]["error_net"] - mean) < 1e-3
    told = {(r["method"], r["territory"]): r for r in P.mae_methods(P.backtest_methods(df)).collect()}
    naive = [abs(r["error"]) for k, r in errors.items() if k[0] == "naive" and k[1] == "b" and k[3] == 12]
    assert abs(told["naive", "b"]["mae_level"] - np.mean(naive)) < 0.06


def test_smoothing_finds_a_pattern():
    t = np.arange(60)
    y = np.exp(4 + 0.3 * np.sin(2 * np.pi * t / 12))
    assert np.allclose(P._smoothed(y[:48], [48], 12)[0][0], y[48:], rtol=0.02)


def test_band_is_carried_on_by_the_root_of_the_horizon(spark):
    rng, rows = np.random.default_rng(1), []
    for h in range(1, 13):
        rows += [("a", h, float(x)) for x in rng.normal(0, 10, 20 if h <= 9 else 3)]
    got = {r["h"]: r for r in P.band(spark.createDataFrame(rows, "territory string, h int, error double")).collect()}
    q = {h: np.quantile([r[2] for r in rows if r[1] == h], [0.1, 0.9]) for h in range(1, 10)}
    low, high = 0.0, 0.0
    for h in range(1, 25):
        lo, hi = q[h] if h <= 9 else q[9] * np.sqrt(h / 9)
        low, high = (lo, hi) if h == 1 else (min(low, lo), max(high, hi))
        assert abs(got[h]["low"] - low) < 1e-3 and abs(got[h]["high"] - high) < 1e-3 and (got[h]["n"] is None) == (h > 9)


def test_guards_bar_broken_forecasts(spark):
    said = [("fine", 1, 10.0, 8.0, 102.0), ("fine", 2, 9.0, 9.0, 102.0), ("gap", 1, 1.0, 1.0, None), ("minus", 1, -1.0, 0.0, 99.0), ("off", 1, 5.0, 1.0, 101.0), ("band", 1, 1.0, 1.0, 100.0), ("bare", 1, 1.0, 1.0, 100.0)]
    f = spark.createDataFrame(said, "territory string, h int, admissions double, separations double, level double")
    names = sorted({r[0] for r in said})
    bands = spark.createDataFrame([(n, h, 1.0 if n == "band" else -3.0, 4.0) for n in names for h in (1, 2) if n != "bare"], "territory string, h int, low double, high double")
    anchors = spark.createDataFrame([(n, 100) for n in names], "territory string, anchor long")
    mae = spark.createDataFrame([(m, n, 5.0 if (m, n) == ("combined", "off") else 3.0, 3.0) for m in ("combined", "naive") for n in names], "method string, territory string, mae_net double, mae_level double")
    revised = spark.createDataFrame([("gap", True), ("fine", False)], "territory string, beyond_band boolean")
    got = {(r["territory"], r["h"], r["rule"], r["severity"]) for r in P.guards(f, bands, anchors, mae, revised).collect()}
    assert got == {("gap", 1, "no level", "block"), ("minus", 1, "negative flow", "block"), ("off", 1, "identity broken", "block"), ("band", 1, "band without centre", "block"), ("bare", 1, "band without centre", "block"), ("off", None, "worse than naive", "warn"), ("gap", None, "revision wider than band", "warn")}


def test_series_are_fitted_in_several_tasks_and_origins_once(spark):
    from pyspark.sql import functions as F

    rows, _ = series(spark, 26)
    many = spark.createDataFrame([(f"{r[0]}{k}", *r[1:]) for k in range(8) for r in rows], "territory string, month long, admissions long, separations long, net long, level long")
    dealt = P.holt_winters(many, 2).withColumn("task", F.spark_partition_id())
    assert dealt.select("territory").distinct().count() == 16 and dealt.select("task").distinct().count() > 1
    smooth = P.holt_winters(many, 24, first_origin=24).localCheckpoint()
    errors = P.backtest_methods(many, 24, 24, smooth)
    assert "FlatMapGroupsInPandas" not in errors._jdf.queryExecution().sparkPlan().toString()
    assert errors.exceptAll(P.backtest_methods(many)).count() == 0 and errors.count() > 0
