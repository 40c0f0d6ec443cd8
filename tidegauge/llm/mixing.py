"""Mixing to target weights by soft membership, with DataFrame functions only.

Domains come from the labelled table: ``good`` (quality 1, not toxic), ``poor`` (quality 0) and ``toxic``.  A
classifier of telling words, calibrated on labels held out, gives every document a posterior over the domains.  Document rates r >= 0 then
bring the expected token totals sum(r * tokens * posterior) to weight * total with the least change from r = 1,
by projected-gradient least squares; a domain of too few tokens stays below its goal.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, stored

DOMAINS = ["good", "poor", "toxic"]
#: The share of tokens that each domain is to have.
TARGETS = {"good": 0.97, "poor": 0.01, "toxic": 0.02}


def _words(text: Column) -> Column:
    """Words in lower case, the signs at their ends apart."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+|(?<=\p{L})(?=\p{Punct})")


def _signs(words: Column) -> Column:
    """Hashes of the distinct words, and of one sign more: which fifth of the words repeat the word before."""
    before = F.concat(F.array(F.lit(None).cast("string")), words)
    again = F.size(F.filter(F.zip_with(words, before, lambda w, b: w == b), lambda x: x))
    fifth = F.concat(F.lit("\n"), F.floor(5 * again / F.size(words)).cast("string"))
    return F.array_distinct(F.transform(F.concat(words, F.array(fifth)), lambda w: F.xxhash64(w)))


def _telling(counts: DataFrame, n: dict[int, int], least_share: float = 0.01, least_gain: float = 20.0) -> tuple[list[float], dict[int, list[float]]]:
    """Log priors with what the absence of all telling words says, and hash -> log-odds of each domain but the first against the others.

    A word tells of a domain if its odds there differ by a factor of e**2 and its G statistic is at least ``least_gain`` (a chance of
    some 1e-5).  Only words in ``least_share`` of the texts of a domain, or of the others, come to the driver: at
    most 1 / least_share times the distinct words of a mean text for each.
    """
    import math

    k, total = len(DOMAINS), sum(n.values())
    priors = [math.log((n.get(d, 0) + 1) / (total + k)) for d in range(k)]
    often = F.lit(False)
    for d in range(1, k):
        often = often | (F.col(f"n{d}") >= least_share * max(n.get(d, 0), 1)) | (F.col("all") - F.col(f"n{d}") >= least_share * (total - n.get(d, 0)))
    odds = {}
    for r in counts.where(often & (F.col("all") >= 8)).collect():
        own = []
        for d in range(1, k):
            inside, outside, size, rest = r[f"n{d}"], r["all"] - r[f"n{d}"], n.get(d, 0), total - n.get(d, 0)
            here, there = (inside + 0.5) / (size + 1), (outside + 0.5) / (rest + 1)
            cells = [(inside, size * r["all"]), (outside, rest * r["all"]), (size - inside, size * (total - r["all"])), (rest - outside, rest * (total - r["all"]))]
            gain = 2 * sum(seen * math.log(seen * total / due) for seen, due in cells if seen > 0)
            tells = size > 0 and rest > 0 and abs(math.log(here / there)) >= 2 and gain >= least_gain
            absent = math.log((1 - here) / (1 - there)) if tells and max(here, there) < 1 else 0.0
            own.append(round(math.log(here / there) - absent, 4) if tells else 0.0)
            priors[d] += absent
        if any(own):
            odds[r["word"]] = own
    return priors, odds


def _calibrated(rows: list, priors: list[float], pull: float = 3.0):
    """The affine map of the summed log-odds under which posteriors agree with ``rows`` (a, b, tokens, domain), by Newton steps.

    Multinomial logistic regression weighted by tokens, so that expected tokens a domain are those labelled; ``pull`` draws it
    to the map that changes nothing, which is what it gives without rows.  Returns a 2 x 3 list (for a, b and 1).
    """
    import numpy as np

    start = np.array([[1.0, 0.0, priors[1] - priors[0]], [0.0, 1.0, priors[2] - priors[0]]])
    if not rows:
        return start.tolist()
    raw = np.array([[r[0], r[1], 1.0] for r in rows])
    weight = np.array([max(r[2], 1.0) for r in rows])
    weight = weight / weight.mean()
    truth = np.array([[r[3] == 1, r[3] == 2] for r in rows], dtype=float)
    scale = np.array([1.0, 1.0, 0.1])  # the constant is drawn less

    def loss(m):
        z = np.clip(raw @ m.T, -30, 30)
        return (weight * (np.log1p(np.exp(z).sum(1)) - (truth * z).sum(1))).sum() + pull * (scale * (m - start) ** 2).sum() / 2

    m = start
    for _ in range(50):
        e = np.exp(np.clip(raw @ m.T, -30, 30))
        p = e / (1 + e.sum(1, keepdims=True))
        slope = ((weight[:, None] * (p - truth)).T @ raw + pull * scale * (m - start)).ravel()
        curve = np.diag(np.tile(pull * scale, 2)).astype(float)
        for i in range(2):
            for j in range(2):
                w = weight * p[:, i] * ((i == j) - p[:, j])
                curve[3 * i : 3 * i + 3, 3 * j : 3 * j + 3] += (raw * w[:, None]).T @ raw
        step, now = np.linalg.solve(curve, slope).reshape(2, 3), loss(m)
        for _ in range(30):
            if loss(m - step) <= now:
                break
            step = step / 2
        m = m - step
        if np.abs(step).max() < 1e-6:
            break
    return m.tolist()


def train(docs: DataFrame, labels: DataFrame, sampled: int = 6000) -> tuple[list[list[float]], dict[int, list[float]]]:
    """The calibrated map (see ``_calibrated``), and the telling words (see ``_telling``).

    Fits on at most ``sampled`` labelled documents by hash of doc_id, each text once a word: words on four fifths of them,
    the map on the fifth that no word has seen.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    domain = F.when(F.col("quality") == 0, 1).when(F.col("toxic") == 1, 2).otherwise(0)
    drawn = known.select("doc_id", domain.alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sampled)
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").withColumn("apart", F.pmod(F.xxhash64(F.lit("apart"), "doc_id"), F.lit(5)) == 0), "labelled")
    seen = rows.where(~F.col("apart"))
    n = {r["domain"]: r["n"] for r in seen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    words = seen.select("domain", _words(F.col("text")).alias("words")).select("domain", F.explode(_signs(F.col("words"))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("all"), *[F.count(F.when(F.col("domain") == d, 1)).alias(f"n{d}") for d in range(len(DOMAINS))])
    priors, odds = _telling(counts, n)
    apart = _summed(rows.where("apart"), odds).select(F.col("__s")["a"].alias("a"), F.col("__s")["b"].alias("b"), "__tokens", "domain")
    return _calibrated([tuple(r) for r in apart.collect()], priors), odds


def _slots(odds: dict[int, list[float]]) -> tuple[int, int, list]:
    """(shift, size, slots) such that every telling word has a slot of its own, at its hash shifted, modulo the size."""
    size = 64
    while True:
        for shift in range(48):
            if len({(h >> shift) % size for h in odds}) == len(odds):
                slots: list = [(0, 0.0, 0.0)] * size
                for h, w in odds.items():
                    slots[(h >> shift) % size] = (h, *w)
                return shift, size, slots
        size *= 2


def _summed(docs: DataFrame, odds: dict[int, list[float]]) -> DataFrame:
    """``docs`` with __s (log-odds summed over the telling words) and __tokens (words and runs of signs)."""
    shift, size, slots = _slots(odds)
    place = F.from_json(F.lit(json.dumps([dict(h=h, a=a, b=b) for h, a, b in slots])), "array<struct<h:bigint,a:double,b:double>>")
    words = docs.withColumn("__words", _words(F.col("text")))
    at = lambda h: F.element_at(place, F.pmod(F.shiftright(h, shift), F.lit(size)).cast("int") + 1)
    told = F.filter(_signs(F.col("__words")), lambda h: at(h)["h"] == h)
    summed = F.aggregate(told, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b")), lambda s, h: F.struct((s["a"] + at(h)["a"]).alias("a"), (s["b"] + at(h)["b"]).alias("b")))
    return words.withColumn("__s", summed).withColumn("__tokens", F.size(F.filter("__words", lambda w: w != "")).cast("double")).drop("__words")


def with_posteriors(docs: DataFrame, model: tuple) -> DataFrame:
    """``docs`` with __tokens (words and runs of signs) and __p (the posterior of each domain, in DOMAINS' order)."""
    fitted, odds = model
    s = F.col("__s")
    raw = [F.lit(0.0), *[F.greatest(F.lit(-30.0), F.least(F.lit(30.0), s["a"] * m[0] + s["b"] * m[1] + m[2])) for m in fitted]]
    e = [F.exp(x) for x in raw]
    return _summed(docs, odds).withColumn("__p", F.transform(F.array(*e), lambda x: x / sum(e[1:], e[0]))).drop("__s")


def _rate(steps: list[list[float]]) -> Column:
    """r from 1 by moves along the document's own posterior, each projected to r >= 0; a rate within 0.01 of a whole number is it."""
    moves = F.from_json(F.lit(json.dumps(steps)), "array<array<double>>")
    moved = lambda r, h: F.greatest(F.lit(0.0), r - sum((F.col("__p")[d] * h[d] for d in range(1, len(DOMAINS))), F.col("__p")[0] * h[0]))
    return F.aggregate(moves, F.lit(1.0), moved, lambda r: F.when(F.abs(r - F.round(r)) <= 0.01, F.round(r)).otherwise(r))


def fit(rows: DataFrame, targets: dict[str, float], total: float | None = None, most_steps: int = 60, close: float = 3e-3) -> list[list[float]]:
    """The moves that bring the token totals to their goals: projected-gradient least squares, a row of sums an iteration.

    With rates r, tokens t and posteriors p, the squared miss of the totals sum(t r p) has the gradient t p . miss.  Each iteration moves
    every rate by r = max(0, r - p . h), h the miss preconditioned by the Gram matrix of the rows that aren't at zero, halved until the squared miss falls.
    ``total`` is the number of tokens wanted; by default that of which the good documents,
    kept once, have their share.  A domain that has less than its share of it is then left as it is, never made
    up for by dropping others, and a warning tells what it has; so it does if goals are not met to ``close``.
    """
    import warnings

    import numpy as np

    k = len(DOMAINS)
    p = [F.col("__p")[d] for d in range(k)]

    def at(moves):
        t = F.col("__tokens")
        rated = rows.select(_rate(moves).alias("r"), t.alias("__tokens"), "__p")
        on = F.when(F.col("r") > 0, t).otherwise(0.0)
        now = rated.agg(*[F.sum(t * F.col("r") * p[d]).alias(f"t{d}") for d in range(k)], *[F.sum(on * p[i] * p[j]).alias(f"g{i}{j}") for i in range(k) for j in range(k)]).first()
        return np.array([now[f"t{d}"] or 0.0 for d in range(k)]), np.array([[now[f"g{i}{j}"] or 0.0 for j in range(k)] for i in range(k)])

    have, gram = at([])
    if not have.sum():
        return []
    weight = np.array([targets[d] for d in DOMAINS], dtype=float)
    asked = total
    if not total:
        total = have[0] / weight[0] if weight[0] > 0 and have[0] > 0 else min(h / w for h, w in zip(have, weight) if w > 0 and h > 0)
    goal = total * weight
    bound = (have >= goal * (1 - 1e-9)) | bool(asked)
    allowed = close * np.where(goal > 0, goal, 1e-3 * total)
    missed = lambda have: np.where(bound, have - goal, 0.0)
    cost = lambda have: float(((missed(have) / allowed) ** 2).sum())
    moves: list[list[float]] = []
    for _ in range(most_steps):
        bound = bound | (have > goal + allowed)
        if (abs(missed(have)) <= allowed).all():
            break
        free = np.flatnonzero(bound)
        part = gram[np.ix_(free, free)]
        h = np.zeros(k)
        h[free] = np.linalg.solve(part + 1e-9 * (np.trace(part) + 1e-12) * np.eye(len(free)), missed(have)[free])
        for _ in range(12):
            new, new_gram = at([*moves, h.tolist()])
            if cost(new) < cost(have) * (1 - 1e-6):
                break
            h = h / 2
        else:
            break
        moves, have, gram = [*moves, h.tolist()], new, new_gram
    unmet = {DOMAINS[d]: f"{have[d]:.0f} of {goal[d]:.0f} tokens" for d in range(k) if abs(have[d] - goal[d]) > allowed[d]}
    if unmet:
        warnings.warn(f"mixing: goals not met: {unmet}", stacklevel=2)
    return moves


def _decided(rows: DataFrame, steps: list[list[float]]) -> DataFrame:
    """__rate, and __copies: the rate rounded down or up by a hash of doc_id, so that its mean is the rate."""
    u = F.pmod(F.xxhash64("doc_id", F.lit("mix")), F.lit(1_000_003)) / 1_000_003.0
    return rows.withColumn("__rate", _rate(steps)).withColumn("__copies", F.floor(F.col("__rate") + u).cast("int"))


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, total: float | None = None) -> DataFrame:
    """doc_id, tokens, p_good, p_poor, p_toxic, rate and copies of every row.

    Null or empty texts have no tokens and get the rate of their prior posterior; repeated rows have equal rates; a null doc_id is kept; an empty
    table gives no rows; a domain with too few tokens is kept whole and stays below its target (see ``fit``).
    """
    model = train(docs, labels)
    rows = cut(with_posteriors(docs.select("doc_id", "text"), model).select("doc_id", "__tokens", "__p"))
    out = _decided(rows, fit(rows, targets, total))
    return out.select("doc_id", F.col("__tokens").cast("long").alias("tokens"), *[F.col("__p")[d].alias(f"p_{name}") for d, name in enumerate(DOMAINS)], F.col("__rate").alias("rate"), F.col("__copies").alias("copies"))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, total: float | None = None) -> DataFrame:
    """``docs``, all columns, each row as many times as its rate says.

    Nulls, empty texts, repeated rows and scarce domains are treated as ``rates`` has it; an empty table stays empty.
    """
    model = train(docs, labels)
    rows = stored(with_posteriors(docs, model), "mixing")
    out = _decided(rows, fit(rows, targets, total)).where("__copies > 0")
    once = out.where("__copies = 1").select(*[f"`{c}`" for c in docs.columns])
    more = out.where("__copies > 1").withColumn("__n", F.explode(F.sequence(F.lit(1), "__copies"))).select(*[f"`{c}`" for c in docs.columns])
    return once.unionByName(more)
