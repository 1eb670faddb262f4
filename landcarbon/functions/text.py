"""Column expressions on attribute text and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keeps word characters of any script, blanks, carets and commas.
PUNCTUATION = r"(?U)[^\w\s^,]"

# Fixed value: the entry that refers to the notes.
OTHER_IN_NOTES = "Other (please specify in Notes)"

# Old codes of the current use, rewritten in this order.
USE_CODES: list[tuple[str, str]] = [
    ("5,4", "Forestry"),
    ("1,3,4", ""),
    ("3,4,1", ""),
    ("1,4", ""),
    ("1,", ""),
]
# Fixed value: rewritten last, and only where it is the whole text.
LONE_USE_CODE = ("4", "Deer Management")

# Stems of techniques that point to forestry, case-sensitive.
FORESTRY_STEMS = ["forest", "stump", "tree", "smooth", "mulching", "regen", "furrow", "felling", "scrub"]


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def text_or_notes(text: Column | str, notes: Column | str, pattern: str = PUNCTUATION) -> Column:
    """Text without punctuation; where it mentions "other", followed by the notes (NULL notes give NULL)."""
    text = _col(text)
    clean = F.regexp_replace(text, pattern, "")
    return F.when(text.ilike("%Other%"), F.concat(clean, F.lit(" - "), _col(notes))).otherwise(clean)


def technique_or_notes(technique: Column | str, notes: Column | str) -> Column:
    technique = _col(technique)
    return F.when(technique == OTHER_IN_NOTES, _col(notes)).otherwise(technique)


def clean_current_use(use: Column | str) -> Column:
    use = _col(use)
    for code, meaning in USE_CODES:
        use = F.replace(use, F.lit(code), F.lit(meaning))
    code, meaning = LONE_USE_CODE
    return F.when(use == code, F.lit(meaning)).otherwise(use)


def names_forestry_technique(techniques: Column | str) -> Column:
    return _col(techniques).rlike("|".join(FORESTRY_STEMS))


def mentions(text: Column | str, word: str) -> Column:
    """Whether a text contains a word in any case; NULL for NULL."""
    return _col(text).ilike(f"%{word}%")


def distinct_concat(value: Column | str, sep: str = ",") -> Column:
    """Aggregate: the distinct values in order, joined; NULL if there is none."""
    values = F.array_sort(F.collect_set(_col(value)))
    return F.when(F.size(values) > 0, F.array_join(values, sep))


def id_list(ids: Column | str, sep: str = ",") -> Column:
    """A comma-joined id column as an array; an empty text holds no id."""
    ids = _col(ids)
    return F.when(ids == "", F.array().cast("array<string>")).otherwise(F.split(ids, sep))


def grid_reference(x: Column | str, y: Column | str, digits: int = 10) -> Column:
    """British National Grid reference of a point in EPSG:27700: two letters, then eastings and northings.

    The format of the reference's own function is not known; this is the public lettering of 100 km squares with
    ``digits`` figures in all, 10 meaning whole metres. Outside the lettered area the result is NULL.
    """
    if digits % 2 or not 0 <= digits <= 10:
        raise ValueError("digits must be even, from 0 to 10")
    east, north = (F.floor(_col(v).cast("double")).cast("long") for v in (x, y))
    square = 100_000
    e, n = F.floor(east / square), F.floor(north / square)
    # 5 x 5 letters without I: first the 500 km square, then the 100 km square in it, rows from the north.
    letters = "ABCDEFGHJKLMNOPQRSTUVWXYZ"
    first = (F.lit(19) - n) - (F.lit(19) - n) % 5 + F.floor((e + 10) / 5)
    second = ((F.lit(19) - n) * 5) % 25 + e % 5
    parts = [F.substring(F.lit(letters), (i + 1).cast("int"), F.lit(1)) for i in (first, second)]
    if digits:
        half = digits // 2
        for metres in (east, north):
            parts.append(F.lpad(F.floor(metres % square / 10 ** (5 - half)).cast("string"), half, "0"))
    inside = (e >= 0) & (e < 7) & (n >= 0) & (n < 13)
    return F.when(inside, F.concat(*parts))
