"""Numbers in text and the facts that bear them out, by unit.

A text is cut into runs of letters, digits, underscores, dots and commas and the gaps between them; each run that begins with
digits is then judged by its fields (what dots part), its decimals and its neighbours.
"""

from __future__ import annotations

from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = r"[\p{L}\p{N}_.,]+"
SIGNS = ("-", "−")
# Marks of a company's identity, and the phrases that the style rules name.
IDENTITY = r"\b(?:LTDA|Ltda|S\.A\.|S/A|EIRELI|CNPJ|ME\b|EPP\b)"
PHRASES = [
    "vale ressaltar", "vale destacar", "cabe destacar", "cabe ressaltar", "é importante notar", "é importante destacar", "no tocante",
    "destaca-se", "destacando-se", "evidenciando", "evidencia-se", "cenário", "impulsionad", "robust", "desafiador", "em suma",
    "nesse sentido", "vale notar", "sublinha", "ressalta-se",
]
STYLE = {"dash": "[—–]", "phrase": "|".join(PHRASES), "relative_month": "mesmo mês do ano anterior", "caveat": "provisóri"}


def _cut(text: Column) -> tuple[Column, Column]:
    """Runs of a text, and the gaps before, between and after them."""
    return F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), F.split(text, RUN, -1)


def _blank(gap: Column) -> Column:
    return F.coalesce((F.length(gap) > 0) & (F.length(F.regexp_replace(gap, r"\s", "")) == 0), F.lit(False))


def _judged(runs: Column, gaps: Column, run: Column, i: Column) -> Column:
    """body (digits with their dots), decimals (with the comma), rest of the run, grouped, i, before and after of a run that begins with a digit."""
    fields = F.split(run, r"\.")
    first = F.element_at(fields, 1)
    full, closing = lambda f: f.rlike("^[0-9]{3}$"), lambda f: f.rlike("^[0-9]{3},")
    begin = F.struct(F.lit(0).alias("k"), F.lit(True).alias("on"))
    step = lambda s, f: F.struct((s.k + F.when(s.on & (full(f) | closing(f)), 1).otherwise(0)).alias("k"), (s.on & full(f)).alias("on"))
    threes = F.aggregate(F.slice(fields, F.lit(2), F.size(fields)), begin, step, lambda s: s.k)
    groups = F.when(first.rlike("^[0-9]{1,3}$"), threes).otherwise(0)
    in_threes = F.transform(F.slice(fields, F.lit(2), groups), lambda f: F.substring(f, 1, 3))
    body = F.when(groups > 0, F.concat_ws(".", first, F.array_join(in_threes, "."))).otherwise(F.regexp_extract(run, "^[0-9]+", 0))
    tail = F.substr(run, F.length(body) + 1)
    decimals = F.regexp_extract(tail, "^,[0-9]+", 0)
    after = F.substr(tail, F.length(decimals) + 1, F.lit(1))
    decimals = F.when(after.isin("", ".", ","), decimals).otherwise("")
    rest = F.substr(tail, F.length(decimals) + 1)
    return F.struct(
        body.alias("body"), decimals.alias("decimals"), rest.alias("rest"), (groups > 0).alias("grouped"), i.alias("i"), F.get(gaps, i).alias("before"),
        F.get(gaps, i + 1).alias("after"), F.get(runs, i + 1).alias("next"),
    )


def _figures(docs: DataFrame, *keys: str) -> DataFrame:
    """keys, runs, gaps and figures: the judged runs of each text that begin with a digit and stand free of letters."""
    runs, gaps = _cut(F.col("text"))
    cut = docs.select(*keys, runs.alias("runs"), gaps.alias("gaps"))
    judged = F.transform("runs", lambda run, i: F.when(run.rlike("^[0-9]"), _judged(F.col("runs"), F.col("gaps"), run, i)))
    return cut.withColumn("figures", F.filter(judged, lambda f: f.isNotNull() & ((f.rest == "") | F.substring(f.rest, 1, 1).isin(".", ","))))


def _signed(f: Column) -> Column:
    """The sign right before a number, unless a run touches it from the other side."""
    last = F.right(f.before, F.lit(1))
    return F.when(last.isin(*SIGNS) & ((f.i == 0) | (F.length(f.before) > 1)), last).otherwise("")


def _masked(labels: list[str]) -> Column:
    """The places of runs that belong to a label, told by its sequence of tokens; a number in a label may be followed by "anos"."""
    low = F.transform("runs", F.lower)
    bare = F.transform(low, lambda r: F.regexp_replace(r, "[.,]+$", ""))
    found = []
    for label in labels:
        tokens = label.lower().split()
        numbers = [k for k, t in enumerate(tokens) if t.isdigit()]
        for chosen in product((False, True), repeat=len(numbers)):
            aged = dict(zip(numbers, chosen))
            said = [w for k, t in enumerate(tokens) for w in ((t, "anos") if aged.get(k) else (t,))]
            found.append(_said(low, bare, said))
    return F.flatten(F.array(*found))


def _said(low: Column, bare: Column, said: list[str]) -> Column:
    """The places of all runs that say these words one after the other, nothing but blanks between them."""
    n = len(said)

    def here(i):
        same = [(F.get(low if k < n - 1 else bare, i + k) == w) & (_blank(F.get("gaps", i + k)) if k else F.lit(True)) for k, w in enumerate(said)]
        return F.coalesce(reduce(lambda a, b: a & b, same), F.lit(False))

    starts = F.sequence(F.lit(0), F.greatest(F.size("runs") - n, F.lit(0)))
    return F.flatten(F.transform(F.filter(starts, here), lambda i: F.sequence(i, i + n - 1)))


def numbers(docs: DataFrame, labels: list[str] = (), keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, place, token, value and thousands of each number in ``text``.

    Dots part thousands, a comma the decimals, a sign may be typographic; digits that touch a letter, or follow a dot or comma,
    are no number.  ``thousands``: "mil" follows.  Numbers inside one of the ``labels`` (of age bands) are left out.  Null and empty texts have none.
    """
    told = _figures(docs, *keys)
    figures = F.col("figures")
    with_digits = [x for x in labels if any(c.isdigit() for c in x)]
    if with_digits:
        told = told.withColumn("masked", _masked(with_digits))
        figures = F.filter(figures, lambda f: ~F.array_contains("masked", f.i))
    mil = lambda f: (f.rest == "") & _blank(f.after) & F.coalesce(F.regexp_replace(F.lower(f.next), "[.,].*$", "") == "mil", F.lit(False))
    shown = F.transform(figures, lambda f: F.struct(F.concat(_signed(f), f.body, f.decimals).alias("token"), mil(f).alias("thousands")))
    found = told.select(*keys, F.posexplode(shown).alias("place", "t"))
    plain = F.translate(F.replace(F.col("t.token"), F.lit("."), F.lit("")), ",−", ".-")
    return found.select(*keys, "place", "t.token", plain.try_cast("double").alias("value"), "t.thousands")


def free(value: Column) -> Column:
    """Numbers that are no data: 1 to 12 and the years 2019 to 2035."""
    return (value == F.floor(value)) & (value.between(1, 12) | value.between(2019, 2035))


def identity(docs: DataFrame) -> DataFrame:
    """doc_id, place, found: every mark of a company's identity."""
    return docs.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(IDENTITY), F.lit(0))).alias("place", "found"))


def style(docs: DataFrame) -> DataFrame:
    """doc_id, rule, n of each style rule that a text breaks.

    A dash, a stock phrase, a percentage without exactly two decimals, "same month of the year before", a minus sign before a number
    (a range has none), and a repeated caveat.
    """
    low = F.lower("text")
    counts = {rule: F.regexp_count(F.col("text") if rule == "dash" else low, F.lit(p)) for rule, p in STYLE.items()}
    in_threes = lambda f: (f.rest == "") & (f.grouped | (F.length(f.body) <= 3))
    marked = lambda f: F.col("text").isNotNull() & (F.regexp_replace(F.left(f.after, F.lit(2)), r"^\s", "").startswith("%"))
    rough = F.size(F.filter("figures", lambda f: in_threes(f) & marked(f) & (F.length(f.decimals) != 3)))

    def minus(run, i):
        near = F.regexp_replace(F.get("gaps", i), r"\s$", "")
        head = F.substr(near, F.lit(1), F.greatest(F.length(near) - 1, F.lit(0)))
        apart = F.when(head == "", i == 0).otherwise(F.right(head, F.lit(1)).rlike(r"[\s(\[:;]"))
        return run.rlike("^[0-9]") & F.right(near, F.lit(1)).isin(*SIGNS) & apart

    told = _figures(docs.withColumn("__text", F.col("text")), "doc_id", "__text").withColumnRenamed("__text", "text")
    counts["percent"] = F.greatest(rough, F.lit(0))
    counts["minus"] = F.greatest(F.size(F.filter(F.transform("runs", minus), lambda x: x)), F.lit(0))
    return told.select("doc_id", *[c.cast("long").alias(r) for r, c in counts.items()]).unpivot(["doc_id"], list(counts), "rule", "n").where("n > 0")


def renderings(facts: DataFrame, *keys: str) -> DataFrame:
    """keys, id, value, thousands: the ways in which a fact (id, value, unit) may be written, by unit; halves round away from zero."""
    v = F.abs(F.col("value").cast("decimal(24,6)"))
    forms = lambda thousands, *xs: [F.struct(x.cast("decimal(24,6)").alias("value"), F.lit(thousands).alias("thousands")) for x in xs]
    percent = F.array(*forms(False, F.round(v, 0), F.round(v, 1), F.round(v, 2)))
    money = F.array(*forms(False, F.round(v, 2), F.round(v, 0)))
    count = F.array(*forms(False, v), *forms(True, F.round(v / 1000, 1), F.round(v / 1000, 0)))
    ways = F.when(F.col("unit").isin("percent", "points", "millions"), percent).when(F.col("unit") == "money", money).otherwise(count)
    return facts.where("value is not null").select(*keys, "id", F.explode(F.array_distinct(ways)).alias("w")).select(*keys, "id", F.col("w.value").cast("double").alias("value"), "w.thousands")


def explained(tokens: DataFrame, facts: DataFrame, *scope: str) -> DataFrame:
    """Number tokens (with ``value`` made absolute) and whether a fact of their scope says them: by a rendering of its unit, or before "mil" a thousand-fold."""
    said = renderings(facts, *scope).select(*scope, "value", "thousands")
    said = said.union(said.where("not thousands").select(*scope, (F.col("value") / 1000).alias("value"), F.lit(True))).distinct().withColumn("said", F.lit(True))
    asked = tokens.withColumn("value", F.abs("value"))
    return asked.join(said, [*scope, "value", "thousands"], "left").withColumn("said", F.coalesce("said", F.lit(False)))


def ungrounded(tokens: DataFrame, facts: DataFrame, *scope: str) -> DataFrame:
    """Number tokens that no fact (id, value, unit) of their scope explains; 1 to 12 and the years are free unless "mil" follows."""
    return explained(tokens, facts, *scope).where(~F.col("said") & (F.col("thousands") | ~free(F.col("value"))))


def allowed(rules: list[tuple[str, tuple[str, ...]]]) -> Column:
    """Whether a fact's id may be said in running text: its family and its last part are those of a rule (no parts: any)."""
    family, last = F.substring_index("id", ".", 1), F.substring_index("id", ".", -1)
    out = F.lit(False)
    for of, parts in rules:
        out = out | ((family == of) & (last.isin(*parts) if parts else F.lit(True)))
    return out


def only_in_tables(tokens: DataFrame, facts: DataFrame, rules: list[tuple[str, tuple[str, ...]]], *scope: str) -> DataFrame:
    """Number tokens that facts of their scope explain, but none of those that the rules allow in running text; free numbers are left alone."""
    told = explained(tokens, facts, *scope).where("said").drop("said")
    return explained(told, facts.where(allowed(rules)), *scope).where(~F.col("said") & ~free(F.col("value")))
