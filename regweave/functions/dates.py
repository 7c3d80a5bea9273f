"""Date layouts to ISO strings.  Every parser is total: bad input gives null or the
documented fallback, never an error, under ANSI mode too."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from regweave.functions.text import fold_key, strip

# --- fixed values: month names as the registers write them ------------------------
SPANISH_MONTHS = {"ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6, "jul": 7,
                  "ago": 8, "set": 9, "sep": 9, "oct": 10, "nov": 11, "dic": 12}
GERMAN_MONTHS = ("januar", "februar", "märz", "april", "mai", "juni", "juli", "august",
                 "september", "oktober", "november", "dezember")
# ----------------------------------------------------------------------------------


def literal_map(table: dict) -> Column:
    """A constant lookup table as a map column."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` computed once, however often ``fn`` uses it."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _parsed(text: Column, shape: str, layout: str) -> Column:
    """ISO text of a value that has the shape and is a real date, else null.

    The shape test keeps the lenient digit counts of the date parser out.
    """
    return F.when(text.rlike(shape), F.try_to_date(text, layout).cast("string"))


def _from_parts(text: Column, shape: str, months: dict[str, int]) -> Column:
    """Day, month name and year in that order, found by ``shape``, to ISO or null."""

    def build(t: Column) -> Column:
        day, name, year = (F.regexp_extract(t, shape, i) for i in (1, 2, 3))
        month = F.try_element_at(literal_map(months), F.lower(name)).cast("string")
        return F.try_to_date(F.concat(year, F.lit("-"), month, F.lit("-"), day), "yyyy-M-d").cast("string")

    return bind(text, build)


def us_date_or_same(col: Column) -> Column:
    """``mm/dd/yyyy`` re-ordered to ISO; any other value passes through unchanged."""
    parts = F.split(col, "/")
    three = (F.size(parts) == 3) & ~F.exists(parts, lambda p: p == "")
    month, day = F.try_element_at(parts, F.lit(1)), F.try_element_at(parts, F.lit(2))

    def pad(x: Column) -> Column:  # lpad would cut longer text
        return F.when(F.length(x) < 2, F.lpad(x, 2, "0")).otherwise(x)

    return F.when(
        three, F.concat_ws("-", F.try_element_at(parts, F.lit(3)), pad(month), pad(day))
    ).otherwise(col)


def slash_date(col: Column) -> Column:
    """Strict ``dd/mm/yyyy`` to ISO, else null."""
    return _parsed(strip(col), r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy")


def dotted_date(col: Column) -> Column:
    """Strict ``dd.mm.yyyy`` to ISO, else null."""
    return _parsed(col, r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy")


def slash_date_or_same(col: Column) -> Column:
    """``dd/mm/yyyy`` to ISO; blank gives null, anything else the trimmed text."""
    raw = F.nullif(strip(col), F.lit(""))
    return F.coalesce(slash_date(col), raw)


def spanish_month_date(col: Column) -> Column:
    """``30 Abr. 2029`` to ISO, else null."""
    return _from_parts(fold_key(col), r"^(\d{1,2})\s+([a-z]{3})[a-z]*\.?\s+(\d{4})$", SPANISH_MONTHS)


def german_edition_date(col: Column) -> Column:
    """The edition date in ``... vom 23. Oktober 2026 ...`` as ISO, else null."""
    months = {n: i for i, n in enumerate(GERMAN_MONTHS, start=1)}
    return _from_parts(col, r"(?U)\bvom\s+(\d{1,2})\.\s*([A-Za-zäÄ]+)\s+(\d{4})\b", months)


def dotted_edition_date(col: Column) -> Column:
    """First real ``d.m.yyyy`` date anywhere in a link text or file name."""
    found = F.regexp_extract_all(
        col, F.lit(r"(?<!\d)(\d{1,2}\.\d{1,2}\.\d{4})(?!\d)"), F.lit(1)
    )
    return F.try_element_at(F.filter(F.transform(found, dotted_date), lambda d: d.isNotNull()), F.lit(1))


def iso_date(col: Column) -> Column:
    """A strict ``yyyy-MM-dd`` value, else null."""
    day_text = strip(col)
    return F.when(
        day_text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(day_text, "yyyy-MM-dd").cast("string")
    )
