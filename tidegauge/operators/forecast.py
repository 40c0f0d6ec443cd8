"""Forecasts of many series at once: seasonal rates, naive and damped Holt-Winters, backtest and band."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import months


def series(total: DataFrame) -> DataFrame:
    """territory, month, admissions, separations, net of series without a gap, with their level."""
    n = Window.partitionBy("territory")
    span = months.distance(F.min("month").over(n), F.max("month").over(n)) + 1
    return total.withColumn("n", F.count("*").over(n)).withColumn("span", span).where("n = span").select("territory", "month", "admissions", "separations", (F.col("admissions") - F.col("separations")).alias("net"), "stock")


def backcast(rows: DataFrame) -> DataFrame:
    """The level walked back from the last month: S(t) = S(T) - sum of later nets."""
    by = Window.partitionBy("territory").orderBy("month")
    later = F.coalesce(F.sum("net").over(by.rowsBetween(1, Window.unboundedFollowing)), F.lit(0))
    anchor = F.max_by("stock", "month").over(Window.partitionBy("territory"))
    return rows.select("territory", "month", "admissions", "separations", "net", (anchor - later).alias("level"))


def _ahead(rows: DataFrame, horizon: int) -> DataFrame:
    """territory, h, month (to forecast), last (month) of each series."""
    last = rows.groupBy("territory").agg(F.max("month").alias("last"), F.max_by("level", "month").alias("anchor"))
    return last.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")).withColumn("month", months.shift(F.col("last"), F.col("h")))


def seasonal_rates(rows: DataFrame, horizon: int = 12, years: int = 3, excluded: tuple[int, ...] = ()) -> DataFrame:
    """Rates on the level before, averaged over the last ``years`` same months, without ``excluded`` years; the level is a running product."""
    by = Window.partitionBy("territory").orderBy("month")
    before = F.lag("level").over(by)
    r = rows.select("territory", "month", (F.col("admissions") / F.nullif(before, F.lit(0))).alias("ra"), (F.col("separations") / F.nullif(before, F.lit(0))).alias("rd")).where("ra is not null")
    r = r.where(~F.floor(F.col("month") / 100).isin(*excluded)) if excluded else r
    recent = r.withColumn("k", F.row_number().over(Window.partitionBy("territory", F.col("month") % 100).orderBy(F.desc("month")))).where(F.col("k") <= years)
    mean = recent.groupBy("territory", (F.col("month") % 100).alias("moy")).agg(F.avg("ra").alias("ra"), F.avg("rd").alias("rd"))
    ahead = _ahead(rows, horizon).withColumn("moy", F.col("month") % 100).join(mean, ["territory", "moy"])
    run = Window.partitionBy("territory").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    level = F.col("anchor") * F.product(1 + F.col("ra") - F.col("rd")).over(run)
    out = ahead.select("territory", "h", "month", "ra", "rd", level.alias("level"))
    base = F.col("level") / (1 + F.col("ra") - F.col("rd"))
    return out.select("territory", "h", "month", F.round(base * F.col("ra"), 4).alias("admissions"), F.round(base * F.col("rd"), 4).alias("separations"), F.round("level", 4).alias("level"))


def naive(rows: DataFrame, horizon: int = 24) -> DataFrame:
    """The same month of the last observed year, repeated beyond twelve months."""
    source = months.shift(F.col("month"), -12 * F.ceil(F.col("h") / 12))
    ahead = _ahead(rows, horizon).withColumn("source", source)
    past = rows.select("territory", F.col("month").alias("source"), "admissions", "separations")
    run = Window.partitionBy("territory").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    out = ahead.join(past, ["territory", "source"])
    return out.select("territory", "h", "month", "admissions", "separations", (F.col("anchor") + F.sum(F.col("admissions") - F.col("separations")).over(run)).alias("level"))


def backtest(rows: DataFrame, horizon: int = 12, first_origin: int = 24) -> DataFrame:
    """Errors (real less forecast) of the naive level from every origin that has ``first_origin`` months before it.

    With running nets C, the naive level from origin o at o + h is S(o) + C(o + h - 12) - C(o - 12); all origins
    and horizons are one join.
    """
    by = Window.partitionBy("territory").orderBy("month")
    c = rows.select("territory", months.index(F.col("month")).alias("t"), "level", F.sum("net").over(by.rowsBetween(Window.unboundedPreceding, 0)).alias("c"), F.row_number().over(by).alias("i"))
    origin = c.where(F.col("i") > first_origin).select("territory", F.col("t").alias("o"), "level", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    at = lambda shift, name, col: c.select("territory", (F.col("t") - shift).alias("o"), F.col(col).alias(name))
    year = origin.join(at(-12, "c_year", "c"), ["territory", "o"])
    ends = c.select("territory", (F.col("t") + 12).alias("e"), F.col("c").alias("c_end"))
    real = c.select("territory", F.col("t").alias("e"), F.col("level").alias("real"))
    out = year.withColumn("e", F.col("o") + F.col("h")).join(ends, ["territory", "e"]).join(real, ["territory", "e"])
    return out.select("territory", months.from_index(F.col("o")).alias("origin"), "h", (F.col("real") - F.col("level") - F.col("c_end") + F.col("c_year")).alias("error"))


def band(errors: DataFrame, least: int = 8, horizon: int = 24) -> DataFrame:
    """Tenth and ninetieth hundredths of the errors by horizon, to be added to a forecast.

    A horizon of fewer than ``least`` errors takes those of the last horizon k* that has enough, times sqrt(h / k*).  A band
    never narrows with the horizon.  n is null where it is carried on.
    """
    key, run = Window.partitionBy("territory"), Window.partitionBy("territory").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    q = errors.groupBy("territory", "h").agg(F.count("*").alias("n"), F.percentile("error", F.lit(0.1)).alias("lo"), F.percentile("error", F.lit(0.9)).alias("hi")).where(F.col("n") >= least)
    every = q.select("territory").distinct().select("territory", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    held = every.join(q, ["territory", "h"], "left").withColumn("k", F.max(F.when(F.col("n").isNotNull(), F.col("h"))).over(key))
    for c in ("lo", "hi"):
        last = F.max(F.when(F.col("h") == F.col("k"), F.col(c))).over(key)
        held = held.withColumn(c, F.coalesce(F.col(c), last * F.sqrt(F.col("h") / F.col("k"))))
    return held.select("territory", "h", "n", F.round(F.min("lo").over(run), 4).alias("low"), F.round(F.max("hi").over(run), 4).alias("high"))


def mae(errors: DataFrame) -> DataFrame:
    return errors.groupBy("territory", "h").agg(F.round(F.avg(F.abs("error")), 4).alias("mae"))


#: Bounds of the weights of level, trend and season (each a share of the one before as usual: 0..1) and of the damping.
LOW, HIGH = (1e-4, 1e-4, 1e-4, 0.8), (0.9999, 0.9999, 0.9999, 0.98)


def _months(z, weights, live):
    """After each month of damped additive smoothing: (moments, states), both written over by the next.

    Errors and states are linear in the 14 start states (level, trend, twelve seasons), so each row of ``weights`` (level, trend, season,
    damping) is run from zero states with the data and from each unit start without them.  ``moments`` holds the sums of the products of
    these 15 errors, ``states`` (state x row x run) the states.  Only the first ``live[t]`` rows go through month t.
    """
    import numpy as np

    w = len(weights)
    states = np.zeros((14, w, 15))
    states[np.arange(14), :, np.arange(1, 15)] = 1
    moments = np.zeros((w, 15, 15))
    columns = weights.T[:, :, None]
    for t, k in enumerate(live):
        a, b, g, p = columns[:, :k]
        level, trend, season = states[0, :k], states[1, :k], states[2 + t % 12, :k]
        damped = p * trend
        e = -(level + damped + season)
        e[:, 0] += z[t]
        level += damped + a * e
        trend[:] = damped + a * b * e
        season += g * (1 - a) * e
        moments[:k] += e[:, :, None] * e[:, None, :]
        yield moments, states


def _best(moments):
    """The least sum of squared errors over all start states, and those."""
    import numpy as np

    gram, cross = moments[..., 1:, 1:], moments[..., 0, 1:]
    # the seasons' common level and the level are one: a little ridge tells them apart without moving the fit
    ridge = 1e-9 * np.trace(gram, axis1=-2, axis2=-1)[..., None, None] * np.eye(14)
    start = -np.linalg.solve(gram + ridge, cross[..., None])[..., 0]
    cost = moments[..., 0, 0] + (start * (2 * cross + (gram * start[..., None, :]).sum(axis=-1))).sum(axis=-1)
    return np.maximum(cost, 0), start


def _fitted(z, weights, ends=None):
    """Cost and start states of each row of weights over the first ``ends`` months (all by default), and its states after them."""
    import numpy as np

    ends = np.full(len(weights), len(z)) if ends is None else np.asarray(ends)
    order = np.argsort(-ends, kind="stable")
    live = (ends[:, None] > np.arange(ends.max())).sum(axis=0)
    for moments, states in _months(z, weights[order], live):
        pass
    back = np.argsort(order, kind="stable")
    return *_best(moments[back]), states[:, back]


def _smoothed(y, ends, horizon: int, quick: bool = False):
    """(forecasts, costs) from the first ``ends`` months each: additive damped trend and season of twelve on log flows, by least squares.

    The weights are sought within their bounds by a pattern search from a coarse grid's best points for each weight of the level, the trend and the season: all
    neighbours of all points of all ends are tried in one run, with steps that shrink where none is better.  A run of the grid over all
    months serves every end, as shorter samples are its beginnings.  ``quick`` goes from the best point alone, to a hundredth of the bounds.
    """
    from itertools import product

    import numpy as np

    ends = np.asarray(ends)
    z = np.log(np.maximum(y, 0.5))
    first = z[0]  # a level taken off all months only moves the start level
    z = z - first
    low, high = np.array(LOW), np.array(HIGH)
    coarse = np.array(list(product((1e-4, 0.05, 0.3, 0.7), (0.01, 0.3, 0.7, 0.99), (0.05, 0.4, 0.9), (0.85, 0.97))))
    at, best, of = [], [], []
    for t, (moments, _) in enumerate(_months(z, coarse, [len(coarse)] * int(ends.max()))):
        for i in np.flatnonzero(ends == t + 1):
            cost, _ = _best(moments)
            starts = np.unique([k[cost[k].argmin()] for c in (0, 1, 2) for v in np.unique(coarse[:, c]) for k in [np.flatnonzero(coarse[:, c] == v)]])
            starts = starts[[cost[starts].argmin()]] if quick else starts
            at.append(coarse[starts])
            best.append(cost[starts])
            of.append(np.full(len(starts), i))
    at, best, of = map(np.concatenate, (at, best, of))
    moves = np.concatenate([np.eye(4), -np.eye(4), [[1, 1, 0, 0], [-1, -1, 0, 0], [1, 0, -1, 0], [-1, 0, 1, 0], [1, 0, 1, 0], [-1, 0, -1, 0]]])
    step = np.full(len(at), 0.15)
    for _ in range(40):
        live = np.flatnonzero(step > (1e-2 if quick else 2e-3))
        if not len(live):
            break
        tried = np.clip(at[live, None] + moves[None] * step[live, None, None] * (high - low), low, high)
        c = _fitted(z, tried.reshape(-1, 4), np.repeat(ends[of[live]], len(moves)))[0].reshape(len(live), -1)
        k = c.argmin(axis=1)
        better = c[np.arange(len(live)), k] < best[live] * (1 - 1e-7)
        at[live[better]], best[live[better]] = tried[np.flatnonzero(better), k[better]], c[np.flatnonzero(better), k[better]]
        step[live] *= np.where(better, 1.3, 0.45)
    order = np.lexsort((best, of))
    one = at[order[np.searchsorted(of[order], np.arange(len(ends)))]]
    cost, start, states = _fitted(z, one, ends)
    level, trend, *seasons = states[:, :, 0] + (states[:, :, 1:] * start).sum(axis=-1)
    h = np.arange(1, horizon + 1)
    season = np.array(seasons).T[np.arange(len(ends))[:, None], (ends[:, None] + h - 1) % 12]
    return np.exp(first + level[:, None] + np.cumsum(one[:, [3]] ** h, axis=1) * trend[:, None] + season), cost


def holt_winters(rows: DataFrame, horizon: int = 12, start: int | None = None, first_origin: int | None = None) -> DataFrame:
    """Forecast of admissions and separations of each series, fitted in parallel; levels by the identity.

    The sample begins with month ``start`` (the series' first by default); a sample of fewer than 24 months has no forecast.  With
    ``first_origin``: those from every origin of ``by_origin``, named as there, by the quick fit; all origins of a series (as many as
    its months) are fitted in one go.
    """

    def fit(pdf):
        import numpy as np
        import pandas as pd

        pdf = pdf.sort_values("month")
        origins = range(first_origin, len(pdf) - 1) if first_origin is not None else [len(pdf) - 1]
        before = int((pdf.month < start).sum()) if start else 0
        ends = np.array([i + 1 - before for i in origins if i + 1 - before >= 24], dtype=np.int64)
        if not len(ends):
            return pd.DataFrame({"territory": [], "h": [], "admissions": [], "separations": [], "level": []})
        flows = (pdf[c].to_numpy(dtype=float)[before:] for c in ("admissions", "separations"))
        a, s = (_smoothed(y, ends, horizon, first_origin is not None)[0] for y in flows)
        at = ends + before - 1
        level = pdf.level.astype(float).to_numpy()[at, None] + np.cumsum(a - s, axis=1)
        name = pdf.territory.iloc[0]
        names = [name] if first_origin is None else [f"{name}@{m}" for m in pdf.month.to_numpy()[at]]
        told = {"territory": np.repeat(names, horizon), "h": np.tile(np.arange(1, horizon + 1), len(ends))}
        return pd.DataFrame(told | {"admissions": a.ravel(), "separations": s.ravel(), "level": level.ravel()})

    # series are few and small but slow to fit: dealt out by number, as by size they would all be put into one task
    dealt = rows.select("territory", "month", "admissions", "separations", "level").repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "territory")
    return dealt.groupBy("territory").applyInPandas(fit, "territory string, h int, admissions double, separations double, level double")


def combined(seasonal: DataFrame, smooth: DataFrame) -> DataFrame:
    """Mean of the two methods' flows; the level only through the identity."""
    s = smooth.select("territory", "h", F.col("admissions").alias("a2"), F.col("separations").alias("s2"))
    both = seasonal.join(s, ["territory", "h"])
    first = both.select("territory", "h", "month", ((F.col("admissions") + F.col("a2")) / 2).alias("admissions"), ((F.col("separations") + F.col("s2")) / 2).alias("separations"), (F.col("level") - F.col("admissions") + F.col("separations")).alias("base"))
    by = Window.partitionBy("territory").orderBy("h")
    run = F.sum(F.col("admissions") - F.col("separations")).over(by.rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("level", F.first("base").over(by.rowsBetween(Window.unboundedPreceding, 0)) + run).drop("base")


def by_origin(rows: DataFrame, first_origin: int = 24) -> DataFrame:
    """Each series as known at each origin that has ``first_origin`` months before it and one after, as a series of its own.

    Its territory is "territory@origin", so all methods run on all origins at once.
    """
    by = Window.partitionBy("territory")
    at = rows.select("territory", F.col("month").alias("origin"), F.row_number().over(by.orderBy("month")).alias("i"), F.max("month").over(by).alias("last"))
    origins = at.where((F.col("i") > first_origin) & (F.col("origin") < F.col("last"))).select("territory", "origin")
    known = rows.join(origins, "territory").where("month <= origin")
    return known.withColumn("territory", F.concat_ws("@", "territory", F.col("origin").cast("string"))).drop("origin")


def methods(rows: DataFrame, horizon: int = 24, smooth: DataFrame | None = None) -> DataFrame:
    """method, territory, h, month, admissions, separations, level by seasonal rates, smoothing (``smooth``, fitted here by default), their mean and the naive way."""
    columns = ["territory", "h", "month", "admissions", "separations", "level"]
    seasonal, smooth = seasonal_rates(rows, horizon), holt_winters(rows, horizon) if smooth is None else smooth
    ahead = _ahead(rows, horizon).select("territory", "h", "month")
    every = {"seasonal": seasonal, "smooth": smooth.join(ahead, ["territory", "h"]), "combined": combined(seasonal, smooth), "naive": naive(rows, horizon)}
    doubles = [F.col(c).cast("double").alias(c) for c in columns[3:]]
    return reduce(DataFrame.unionByName, [f.select(F.lit(m).alias("method"), *columns[:3], *doubles) for m, f in every.items()])


def backtest_methods(rows: DataFrame, horizon: int = 24, first_origin: int = 24, smooth: DataFrame | None = None) -> DataFrame:
    """method, territory, origin, h, error (of the level) and error_net of every method: real less forecast.

    ``smooth``: ``holt_winters`` from every origin, read twice; where it isn't given it is fitted at each reading.
    """
    told = methods(by_origin(rows, first_origin), horizon, holt_winters(rows, horizon, first_origin=first_origin) if smooth is None else smooth)
    part = F.split("territory", "@")
    told = told.select("method", part[0].alias("territory"), part[1].cast("long").alias("origin"), "h", "month", "admissions", "separations", F.col("level").alias("said"))
    real = rows.select("territory", "month", F.col("net").alias("real_net"), F.col("level").alias("real"))
    both = told.join(real, ["territory", "month"])
    return both.select("method", "territory", "origin", "h", (F.col("real") - F.col("said")).alias("error"), (F.col("real_net") - F.col("admissions") + F.col("separations")).alias("error_net"))


def mae_methods(errors: DataFrame) -> DataFrame:
    """method, territory, mae_net (up to twelve months ahead) and mae_level (twelve ahead)."""
    net, level = F.when(F.col("h") <= 12, F.abs("error_net")), F.when(F.col("h") == 12, F.abs("error"))
    return errors.groupBy("method", "territory").agg(F.round(F.avg(net), 1).alias("mae_net"), F.round(F.avg(level), 1).alias("mae_level"))


def guards(forecast: DataFrame, bands: DataFrame, anchors: DataFrame, accuracy: DataFrame, revised: DataFrame) -> DataFrame:
    """territory, h, rule, severity of what bars a forecast (block) or is told of it (warn).

    Block: no level, a negative flow, a level that isn't the anchor and the running net, a band that leaves out the centre or is missing.
    Warn: less accurate than the naive method, a revision wider than the band.  ``anchors``: territory, anchor; ``accuracy``: see
    ``mae_methods``; ``revised``: territory, beyond_band.
    """
    run = Window.partitionBy("territory").orderBy("h").rowsBetween(Window.unboundedPreceding, 0)
    rows = forecast.join(anchors, "territory", "left").withColumn("identity", F.col("anchor") + F.sum(F.col("admissions") - F.col("separations")).over(run))
    rows = rows.join(bands.select("territory", "h", "low", "high"), ["territory", "h"], "left")
    missing = F.isnan("level") | F.col("level").isNull()
    broken = {
        "no level": missing,
        "negative flow": (F.col("admissions") < 0) | (F.col("separations") < 0),
        "identity broken": ~missing & ~F.coalesce(F.abs(F.col("level") - F.col("identity")) <= 0.01, F.lit(False)),
        "band without centre": F.coalesce((F.col("low") > 0) | (F.col("high") < 0), F.lit(True)),
    }
    rules = F.filter(F.array(*[F.when(c, F.lit(r)) for r, c in broken.items()]), lambda r: r.isNotNull())
    blocks = rows.select("territory", "h", F.explode(rules).alias("rule"), F.lit("block").alias("severity"))
    side = lambda m, s: accuracy.where(F.col("method") == m).select("territory", F.col("mae_net").alias(f"net{s}"), F.col("mae_level").alias(f"level{s}"))
    worse = side("combined", "_c").join(side("naive", "_n"), "territory").where("net_c > net_n or level_c > level_n")
    warn = lambda df, rule: df.select("territory", F.lit(None).cast("int").alias("h"), F.lit(rule).alias("rule"), F.lit("warn").alias("severity"))
    return blocks.union(warn(worse, "worse than naive")).union(warn(revised.where("beyond_band"), "revision wider than band"))
