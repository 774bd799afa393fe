"""Scalar expressions used by the models and reports."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# What stands for null in surrogate keys; letters and signs that no decomposition takes to ASCII.
NULL_KEY = "_dbt_utils_surrogate_key_null_"
LETTERS = {
    "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Þ": "Th", "þ": "th", "ß": "ss", "Æ": "AE", "æ": "ae",
    "Œ": "OE", "œ": "oe", "ı": "i", "Ħ": "H", "ħ": "h", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "…": "...", "\xa0": " ",
}


def surrogate_key(*columns: Column | str) -> Column:
    """MD5 of the columns as text, joined by '-'."""
    texts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def height_inches(c: Column) -> Column:
    """6' 2" as 74."""
    feet, inches = F.split_part(c, F.lit("'"), F.lit(1)), F.split_part(F.split_part(c, F.lit("'"), F.lit(2)), F.lit('"'), F.lit(1))
    return F.trim(feet).try_cast("int") * 12 + F.trim(inches).try_cast("int")


def body_mass_index(weight: Column, inches: Column, whole: bool = False) -> Column:
    """Pounds and inches; ``whole`` divides integers as a database does, which cuts the quotient."""
    if whole:
        return F.floor(F.try_divide(weight, inches * inches)) * 703
    return F.try_divide(weight, inches * inches) * 703


def clamp_above(c: Column, top: float) -> Column:
    """Values over the top become it; null stays null."""
    return F.when(c > top, F.lit(top)).otherwise(c)


def _to_ascii() -> dict[str, str]:
    """What the letters of the Latin blocks are without their accents."""
    out = dict(LETTERS)
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        plain = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if plain:
            out.setdefault(chr(code), plain)
    return out


def ascii_letters(c: Column) -> Column:
    """Latin letters and common signs as ASCII; other signs that ASCII lacks are left out."""
    known = _to_ascii()
    single = {k: v for k, v in known.items() if len(v) == 1}
    c = F.translate(c, "".join(single), "".join(single.values()))
    for k, v in LETTERS.items():
        if len(v) > 1:
            c = F.replace(c, F.lit(k), F.lit(v))
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def without(c: Column, *others: Column) -> Column:
    """A text without each occurrence of other columns' texts; null or empty ones leave it as it is."""
    for other in others:
        c = F.replace(c, F.coalesce(other, F.lit("")), F.lit(""))
    return c


def without_words(c: Column, words: Sequence[str]) -> Column:
    """Without whole words of a list."""
    return F.regexp_replace(c, rf"\b(?:{'|'.join(words)})\b", "")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def money(c: Column) -> Column:
    """$1,234 as 1234, (1,234) as -1234, anything else as null."""
    plain = F.trim(F.regexp_replace(F.replace(F.replace(c, F.lit("("), F.lit("-")), F.lit(")"), F.lit("")), "[$,]", ""))
    return F.when(plain.rlike(r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"), plain).try_cast("double").cast("bigint")


def dollars(c: Column) -> Column:
    """Millions as $1,234.50M."""
    return F.concat(F.lit("$"), F.format_number(c, 2), F.lit("M"))


def one_decimal(c: Column) -> Column:
    """1234.56 as 1234.6."""
    return F.format_string("%.1f", c.cast("double"))


def given_name_first(c: Column) -> Column:
    """'Last, First' as 'First Last'."""
    return F.when(c.contains(","), F.array_join(F.reverse(F.transform(F.split(c, ",", 2), lambda x: F.trim(x))), " ")).otherwise(F.trim(c))


def plain_name(c: Column) -> Column:
    """Lower case and ASCII, without quoted or bracketed parts and full stops, hyphens as spaces, and with a 'jr' at the end."""
    c = squeeze(ascii_letters(squeeze(F.regexp_replace(F.lower(c), r"\"[^\"]*\"|\([^)]*\)", ""))))
    parts = F.split(F.regexp_replace(c, "[.]", ""), " ")
    rest = F.array_join(F.filter(parts, lambda x: x != "jr"), " ")
    moved = F.when(F.array_contains(parts, "jr"), F.concat(rest, F.lit(" jr"))).otherwise(rest)
    return squeeze(F.replace(moved, F.lit("-"), F.lit(" ")))


def without_initial(c: Column) -> Column:
    """A name of three parts without the middle one, if that is a letter and a full stop."""
    parts = F.split(squeeze(c), " ")
    return F.when((F.size(parts) == 3) & F.get(parts, F.lit(1)).rlike("^.[.]$"), F.concat_ws(" ", F.get(parts, F.lit(0)), F.get(parts, F.lit(2)))).otherwise(c)


def side_of(half: Column, top: Column, bottom: Column) -> Column:
    """One value in the top half of an inning, another in the bottom half, else null."""
    return F.when(half.isin("Top", "T"), top).when(half.isin("Bot", "B"), bottom)


def renamed(c: Column, names: Mapping[str, str]) -> Column:
    """Exact values replaced by others."""
    if not names:
        return c
    return F.coalesce(F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[c], c)


def truth(c: Column) -> Column:
    """Whether a text says yes."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "t", "yes", "y", "1"), F.lit(False))


def scaled_share(c: Column, steps: Sequence[tuple[float, float]], rest: Column) -> Column:
    """A ladder: the first threshold that a value reaches gives its result."""
    out = None
    for low, result in steps:
        out = F.when(c >= low, F.lit(result)) if out is None else out.when(c >= low, F.lit(result))
    return out.otherwise(rest) if out is not None else rest


def round_half_away(c: Column, places: int) -> Column:
    """A double rounded as databases round doubles: its multiple by a power of ten to the nearest whole number, not the decimal that it is shown as."""
    return F.round(c * F.lit(10.0**places)) / F.lit(10.0**places)


def open_end(end: Column, as_of: Column) -> Column:
    """An open end reaches to the day of the report."""
    return F.coalesce(end, as_of)
