"""How numbers, months and names are written in Portuguese."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The months, and words that stay small in names.
MONTHS = ["janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro", "novembro", "dezembro"]

#: Letters of the Latin blocks whose decomposition begins with an ASCII letter, and those letters.
_ACCENTED = {chr(i): unicodedata.normalize("NFKD", chr(i))[0] for i in range(0xC0, 0x250) if unicodedata.normalize("NFKD", chr(i))[0].isascii() and unicodedata.normalize("NFKD", chr(i)) != chr(i)}


def folded(name: Column) -> Column:
    """Key of a name: compatibility letters without accents, lower case, every run of other signs as one underscore (none at the ends)."""
    plain = F.translate(F.regexp_replace(name, r"\p{M}+", ""), "".join(_ACCENTED), "".join(_ACCENTED.values()))
    return F.trim(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "_"), F.lit("_"))


def grouped(digits: Column) -> Column:
    """Digits in threes from the right, parted by dots."""
    return F.reverse(F.regexp_replace(F.reverse(digits), "([0-9]{3})(?=[0-9])", "$1."))


def whole(value: Column, signed: bool = False) -> Column:
    """A whole number with thousands dots and a typographic minus (and a plus, if ``signed``); zero has no sign."""
    n = F.round(value, 0).cast("decimal(20,0)")
    plus = F.when(n > 0, "+").otherwise("") if signed else F.lit("")
    return F.concat(F.when(n < 0, "−").otherwise(plus), grouped(F.abs(n).cast("string")))


def decimals(value: Column, places: int = 2) -> Column:
    """A number with so many decimals after a comma; halves away from zero."""
    n = F.round(value.cast("decimal(24,6)") * 10**places, 0).cast("decimal(24,0)")
    digits = F.lpad(F.abs(n).cast("string"), places + 1, "0")
    digits = F.when(F.length(F.abs(n).cast("string")) > places, F.abs(n).cast("string")).otherwise(digits)
    cut = F.length(digits) - places
    return F.concat(F.when(n < 0, "−").otherwise(""), grouped(F.substr(digits, F.lit(1), cut)), F.lit(","), F.substr(digits, cut + 1))


def money(value: Column) -> Column:
    return F.concat(F.lit("R$ "), decimals(value))


def percentage(value: Column) -> Column:
    return F.concat(decimals(value), F.lit("%"))


def month_label(month: Column, form: str = "long") -> Column:
    """julho de 2026 (long), julho/2026 (slash) or jul/26 (short)."""
    name = F.element_at(F.array(*map(F.lit, MONTHS)), (month % 100).cast("int"))
    year = F.floor(month / 100).cast("string")
    if form == "short":
        return F.concat(F.substring(name, 1, 3), F.lit("/"), F.substring(year, 3, 2))
    return F.concat(name, F.lit(" de " if form == "long" else "/"), year)


def activity_name(name: Column, short: dict[str, str] | None = None) -> Column:
    """A readable name: the short one where there is one; an all-capitals name with just its first letter large; others as they are."""
    calm = F.when((F.upper(name) == name) & (F.lower(name) != name), F.concat(F.upper(F.substring(name, 1, 1)), F.lower(F.substr(name, F.lit(2))))).otherwise(name)
    if not short:
        return calm
    known = F.create_map(*[F.lit(x) for pair in short.items() for x in pair])
    return F.coalesce(known[name], calm)
