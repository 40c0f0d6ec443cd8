"""Sector, profile, code and format functions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Section letter -> first and last division of the activity classification.
SECTIONS = {"A": (1, 3), "B": (5, 9), "C": (10, 33), "D": (35, 35), "E": (36, 39), "F": (41, 43), "G": (45, 47), "H": (49, 53), "I": (55, 56), "J": (58, 63), "K": (64, 66), "L": (68, 68), "M": (69, 75), "N": (77, 82), "O": (84, 84), "P": (85, 85), "Q": (86, 88), "R": (90, 93), "S": (94, 96), "T": (97, 97), "U": (99, 99)}
GROUPINGS = ["Agropecuária", "Indústria", "Construção", "Comércio", "Serviços", "Não Identificado"]
UNIDENTIFIED = GROUPINGS[-1]
# Sections -> subgrouping.
SUBGROUPINGS = {
    "A": "Agropecuária",
    "C": "Indústrias de Transformação",
    "BDE": "Indústria geral",
    "F": "Construção",
    "G": "Comércio, reparação de veículos automotores e motocicletas",
    "H": "Transporte, armazenagem e correio",
    "I": "Alojamento e alimentação",
    "JKLMN": "Informação, comunicação e atividades financeiras, imobiliárias, profissionais e administrativas",
    "OPQ": "Administração pública, defesa, seguridade social, educação, saúde humana e serviços sociais",
    "RSU": "Outros serviços",
    "T": "Serviços domésticos",
}
NO_SUBCLASS = 9999999
AGE_BANDS = [(17, "até 17"), (24, "18 a 24"), (29, "25 a 29"), (39, "30 a 39"), (49, "40 a 49"), (64, "50 a 64")]


def section_of(division: Column) -> Column:
    """The section that a division number lies in, by a map lookup; null outside all ranges."""
    pairs = [(F.lit(d), F.lit(s)) for s, (lo, hi) in SECTIONS.items() for d in range(lo, hi + 1)]
    return F.create_map(*chain(*pairs))[division.cast("int")]


def grouping_of(section: Column) -> Column:
    g = F.when(section == "A", GROUPINGS[0]).when(section.isin("B", "C", "D", "E"), GROUPINGS[1])
    return g.when(section == "F", GROUPINGS[2]).when(section == "G", GROUPINGS[3]).when(section.isNull() | (section == "Z"), UNIDENTIFIED).otherwise(GROUPINGS[4])


def subgrouping_of(section: Column) -> Column:
    """The second level: twelve classes of sections."""
    out = None
    for letters, label in SUBGROUPINGS.items():
        out = (F.when if out is None else out.when)(section.isin(*letters), label)
    return out.otherwise(UNIDENTIFIED)


def division_label(subclass: Column) -> Column:
    """Two-digit division; NI where the activity isn't identified."""
    known = subclass.isNotNull() & (subclass != NO_SUBCLASS)
    return F.when(known, F.lpad(F.floor(subclass / 100000).cast("string"), 2, "0")).otherwise("NI")


def sex_label(sex: Column) -> Column:
    return F.when(sex == 1, "Homem").when(sex == 3, "Mulher").otherwise(UNIDENTIFIED)


def age_band(age: Column) -> Column:
    band = F.when(age.isNull(), UNIDENTIFIED)
    for top, label in AGE_BANDS:
        band = band.when(age <= top, label)
    return band.otherwise("65 ou mais")


def effect(feed: Column, sign: Column) -> Column:
    """On-time and late records add their sign, an exclusion takes it back."""
    return F.when(feed == "EXC", -sign).otherwise(sign)


def percent(part: Column, whole: Column) -> Column:
    """Per cent with two decimals, halves away from zero; null without a base.

    The hundredths are floored from whole numbers, so that no tie depends on how a quotient was rounded.
    """
    size = F.floor((20000 * F.abs(part) + F.abs(whole)) / F.nullif(2.0 * F.abs(whole), F.lit(0.0)))
    return F.signum(part) * F.signum(whole) * size / 100.0 + 0.0


def rounded_mean(cents: Column, n: Column) -> Column:
    """Mean of whole cents as money, rounded half up without passing through a quotient of doubles."""
    return F.floor((2 * cents + n) / (2 * n)).cast("long") / 100.0


def cents(value: Column) -> Column:
    return F.round(value * 100).cast("long")


def check_digit(code6: Column) -> Column:
    """Seven-digit municipality code: weights 1 and 2 in turn, digits of products summed."""
    total = F.lit(0)
    for i in range(6):
        d = F.floor(code6 / 10 ** (5 - i)) % 10
        p = d * (1 + i % 2)
        total = total + F.when(p > 9, p - 9).otherwise(p)
    return (code6 * 10 + (10 - total % 10) % 10).cast("long")


def subclass_code(raw: Column) -> Column:
    """Seven digits of a subclass given as text, perhaps without its leading zero."""
    return F.lpad(F.trim(raw), 7, "0")


def section_of_code(code: Column) -> Column:
    """The section of a seven-digit subclass; Z for the sentinel, a null, or a division in no section."""
    section = section_of(F.substring(code, 1, 2).try_cast("int"))
    return F.coalesce(F.when(code != str(NO_SUBCLASS), section), F.lit("Z"))
