"""Secret scans by Markov models of characters, with DataFrame functions only.

Two first-order models, one of random strings and one of ordinary identifiers, are trained from labelled
samples of the table itself: words of the sampled texts are the ordinary ones, digests of their documents' ids in
base 16, 36 and 64 are the random ones.  A candidate's score is its mean log-likelihood ratio a character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drawn, id_and_text

# Fixed values of the contract: the three base patterns, kinds in their order, least lengths.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "markov"]
#: What the method scores: long runs of the alphabet, then runs of letters and digits (not of digits alone) in what is left.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SHORT = r"(?<![A-Za-z0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]{12,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Matches that are walked at a time, so that the work of a text stays about linear in its matches.
WALK = 256


def masked(text: Column, pattern: str, chosen=None) -> Column:
    """``text`` with the matches (those that ``chosen`` picks) replaced by as many spaces, so that places stay."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(pieces, 1, F.size(found)).alias("before"), found.alias("whole"))
    blank = lambda m: F.repeat(F.lit(" "), F.length(m["whole"]))
    put = lambda m: F.concat(m["before"], F.when(chosen(m["whole"]), blank(m)).otherwise(m["whole"]) if chosen else blank(m))
    return F.when(text.rlike(pattern), F.concat(F.array_join(F.transform(zipped, put), ""), F.element_at(pieces, -1))).otherwise(text)


def spans(text: Column, pattern: str, kind: str, group: int | None = None, least: int = 0) -> Column:
    """Array of (start, kind number, end, value): leftmost non-overlapping matches, in code points.

    What lies between matches comes from a split by the same pattern, so lengths add up to places.  With
    ``group``, matches whose group is shorter than ``least`` are dropped (they still use up their text).
    """
    order = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    zipped = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(found)).alias("before"), found.alias("whole"), groups.alias("part"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def walk(matches: Column) -> Column:
        """(at, out): the length of these matches with what lies before each, and their spans."""
        begin = lambda acc, m: acc["at"] + F.length(m["before"])
        end = lambda acc, m: begin(acc, m) + F.length(m["whole"])
        span = lambda acc, m: F.struct(begin(acc, m).alias("start"), F.lit(order).alias("kind"), end(acc, m).alias("end"), m["part"].alias("value"))
        return F.aggregate(matches, F.struct(F.lit(0).alias("at"), empty.alias("out")), lambda acc, m: F.struct(end(acc, m).alias("at"), F.concat(acc["out"], F.array(span(acc, m))).alias("out")))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / WALK).cast("int")), lambda b: walk(F.slice(zipped, b * WALK + 1, WALK)))
    shift = lambda s, by: F.struct((s["start"] + by).alias("start"), s["kind"].alias("kind"), (s["end"] + by).alias("end"), s["value"].alias("value"))
    nested = F.array().cast("array<array<struct<start:int,kind:int,end:int,value:string>>>")
    walked = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), nested.alias("out")),
        lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["out"], F.array(F.transform(b["out"], lambda s: shift(s, acc["at"])))).alias("out")),
        lambda acc: F.flatten(acc["out"]),
    )
    kept = F.filter(walked, lambda s: F.length(s["value"]) >= least) if least else walked
    return F.when(text.rlike(pattern), kept).otherwise(empty)


def _bigrams(words: DataFrame) -> DataFrame:
    """label, a, b (places in the alphabet from 1) and count."""
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))).alias("two")
    pairs = words.where(F.length("word") > 1).select("label", pair).groupBy("label", "two").agg(F.count("*").alias("n"))
    alphabet = F.lit(ALPHABET)
    return pairs.select("label", F.instr(alphabet, F.substring("two", 1, 1)).alias("a"), F.instr(alphabet, F.substring("two", 2, 1)).alias("b"), "n").where("a > 0 and b > 0")


def samples(docs: DataFrame, sampled: int = 2000) -> DataFrame:
    """Labelled words: label 1 random, 0 ordinary.  ``sampled`` bounds the documents drawn, by hash of doc_id.

    Ordinary ones are words and identifiers of the texts, with at most four digits at their end.  Random ones are made of digests of the
    ids: in base 16, 36 and 64, whole and of 12 to 19 characters, and of letters only, so that digits alone don't tell.
    """
    texts = drawn(docs, sampled)
    word = r"(?<![A-Za-z0-9+/_=-])[A-Za-z_]+[0-9]{0,4}(?![A-Za-z0-9+/_=-])"
    words = texts.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all("text", F.lit(word), F.lit(0))).alias("word")).where(F.length("word") >= 4)
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("doc_id").cast("string")), 256)
    base64 = F.substring(F.base64(F.unhex(digest)), 1, 40)
    base36 = F.concat(*[F.conv(F.substring(digest, 1 + 12 * i, 12), 16, 36) for i in range(4)])
    letters = F.translate(base36, "0123456789", "QZXJKVWYBG")
    short = lambda s: F.substring(s, F.lit(3), 12 + F.pmod(F.xxhash64("doc_id"), F.lit(8)).cast("int"))
    mixed = F.array(F.substring(digest, 1, 40), base64, F.lower(base36), base36, F.lower(letters), short(base64), short(F.lower(base36)), short(base36))
    ids = texts.select("doc_id").distinct()
    return words.union(ids.select(F.lit(1).alias("label"), F.explode(mixed).alias("word")))


def train(words: DataFrame) -> tuple[list[float], float, float]:
    """The log-likelihood ratio of each pair of characters (row by row), and the calibrated thresholds of long and of short words.

    A pair's chance falls back on that of its second character with the weight of ten pairs.  A threshold is half way between the 99.9th
    hundredth of the ordinary words' scores (of 12 characters or more; a few of them may be secrets) and the hundredth of the random
    strings' scores, but at least 0.3 a character.  At most 67 x 67 counts come to the driver.
    """
    import numpy as np

    k = len(ALPHABET)
    counts = np.zeros((2, k, k))
    for r in _bigrams(words).collect():
        counts[r["label"], r["a"] - 1, r["b"] - 1] += r["n"]
    single = counts.sum(axis=1) + 0.5
    single = (single / single.sum(axis=1, keepdims=True))[:, None, :]
    logs = np.log((counts + 10 * single) / (counts.sum(axis=2, keepdims=True) + 10))
    ratio = np.round(logs[1] - logs[0], 6).ravel().tolist()
    scored = words.where(F.length("word") >= 12).select("label", (F.length("word") >= 20).alias("long"), score(F.col("word"), ratio).alias("s"))
    q = {(r["label"], r["long"]): r for r in scored.groupBy("label", "long").agg(F.percentile("s", F.lit(0.999)).alias("high"), F.percentile("s", F.lit(0.01)).alias("low")).collect()}
    high = max((r["high"] for (label, _), r in q.items() if label == 0), default=0.0)
    least = [max(0.3, (high + (q[1, long]["low"] if (1, long) in q else 1.0)) / 2) for long in (True, False)]
    return ratio, *least


def score(word: Column, ratio: list[float]) -> Column:
    """Mean log-likelihood ratio of a word's character pairs; pairs outside the alphabet count as zero."""
    k, alphabet = len(ALPHABET), F.lit(ALPHABET)
    table = F.array(*[F.lit(x) for x in ratio]) if len(ratio) < 100 else F.from_json(F.lit(str(ratio)), "array<double>")
    places = F.transform(F.split(word, ""), lambda c: F.instr(alphabet, c))
    total = F.aggregate(
        F.arrays_zip(F.slice(places, 1, F.size(places) - 1).alias("a"), F.slice(places, 2, F.size(places)).alias("b")),
        F.lit(0.0),
        lambda s, p: s + F.when((p["a"] > 0) & (p["b"] > 0), F.element_at(table, (p["a"] - 1) * k + p["b"])).otherwise(0.0),
    )
    return total / F.greatest(F.length(word) - 1, F.lit(1))


def scan(docs: DataFrame, sampled: int = 2000) -> DataFrame:
    """doc_id, text and found: the array of (start, kind, end, value) of every row, by start, then kind.

    Base spans are found by pattern and stay.  In what lies outside them, runs of 20 or more characters of the alphabet are
    scored, then runs of 12 or more letters and digits in what that leaves (so a key in a path or beside a base span is seen); those over
    their threshold are added as kind ``markov``, and touch no base span.  Of spans that start together the kinds' order decides; repeated
    rows are kept as they are; null texts count as empty and have no spans; an empty table gives no rows.
    """
    rows = id_and_text(docs)
    ratio, least_long, least_short = train(samples(rows, sampled))
    text = F.col("text")
    base = rows.select("doc_id", "text", spans(text, ASSIGN, "assign", 1, 6).alias("assign"), spans(text, ACCESS, "access").alias("access"), spans(text, HEX, "hex").alias("hex"))
    assigned = F.when(F.size("assign") > 0, masked(text, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6)).otherwise(text)
    rest = base.withColumn("rest", assigned)
    for name, pattern in (("access", ACCESS), ("hex", HEX)):
        rest = rest.withColumn("rest", F.when(F.size(name) > 0, masked(F.col("rest"), pattern)).otherwise(F.col("rest")))
    likely = lambda least: lambda word: score(word, ratio) > least
    over = lambda pattern, least: F.filter(spans(F.col("rest"), pattern, "markov"), lambda c: likely(least)(c["value"]))
    long = rest.withColumn("long", over(CANDIDATE, least_long))
    left = F.when(F.size("long") > 0, masked(F.col("rest"), CANDIDATE, likely(least_long))).otherwise(F.col("rest"))
    added = long.withColumn("rest", left).withColumn("added", F.concat("long", over(SHORT, least_short)))
    known = F.concat("assign", "access", "hex")
    return added.select("doc_id", "text", "assign", "access", "hex", "added", F.array_sort(known).alias("known"), F.array_sort(F.concat(known, "added")).alias("found"))


def said(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, sampled: int = 2000) -> DataFrame:
    found = scan(docs, sampled)
    n = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    return found.select("doc_id", n("assign"), n("access"), n("hex"), F.sha2(said(F.col("known")), 256).alias("base_sha256"), said(F.col("found")).alias("spans"), F.size("added").cast("long").alias("n_markov"))
