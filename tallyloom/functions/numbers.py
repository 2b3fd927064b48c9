"""Numbers and dates written the German or the English way."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# The number shapes that decide how a cell is read.
VALUE_WITH_UNIT = r"^\s*([\d.,\s]+)\s*([A-Za-z€$%]{1,6})\s*$"
DE_GROUPED = r"^-?\d{1,3}(\.\d{3})+(,\d+)?$"
DE_DECIMAL = r"^-?\d+,\d+$"
PLAIN_INT = r"^-?\d+$"
PLAIN_FLOAT = r"^-?\d+\.\d+$"
DE_GROUPS_MANY = r"^-?\d{1,3}(\.\d{3}){2,}$"
DE_GROUPS_ONE = r"^-?\d{1,3}\.\d{3}$"
EN_DECIMAL_CLEAR = r"^-?\d+\.(\d{1,2}|\d{4,})$"

# The date shapes, tried in this order.
DATE_SHAPES = (
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", "d.M.yyyy"),
    (r"^\d{1,2}\.\d{1,2}\.\d{2}$", "d.M.yy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"),
)

# A unit in a column header, such as "Storage (GB)".
HEADER_UNIT = (
    r"(?i)(?:\(|\[|\bin\s+)\s*"
    r"(gb|tb|mb|kb|gib|tib|mib|stk|stück|stueck|cores?|kerne?|vcpu|cpus?|"
    r"eur|€|chf|usd|\$|%|h|std|stunden|min|minuten|tage?|days?|jahre?|years?)"
    r"\s*(?:\)|\]|$)")


def number_body(c) -> Column:
    """The digits of a cleaned cell, without a trailing unit."""
    c = col(c)
    with_unit = F.replace(F.regexp_extract(c, VALUE_WITH_UNIT, 1), F.lit(" "), F.lit(""))
    return F.coalesce(F.nullif(with_unit, F.lit("")), c)


def number_unit(c) -> Column:
    return F.nullif(F.regexp_extract(col(c), VALUE_WITH_UNIT, 2), F.lit(""))


def locale_evidence(body) -> dict[str, Column]:
    """What one number body says about the decimal convention of its column."""
    body = col(body)
    german = body.rlike(DE_DECIMAL) | body.rlike(DE_GROUPS_MANY)
    english = ~german & body.rlike(EN_DECIMAL_CLEAR)
    return {"de": german, "en": english,
            "open": ~german & ~english & body.rlike(DE_GROUPS_ONE)}


def decide_locale(any_de: Column, any_en: Column, any_open: Column) -> Column:
    return (F.when(any_de & ~any_en, F.lit("de"))
             .when(any_en & ~any_de, F.lit("en"))
             .when(any_de & any_en, F.lit("ambiguous"))
             .when(any_open, F.lit("ambiguous"))
             .otherwise(F.lit("en")))


def plain_number(body, locale="en") -> Column:
    """A number body in plain digits (``1200.5``), or NULL.

    ``locale`` decides what ``2.500`` is: 2.5 in English, else 2500.
    """
    body = col(body)
    locale = locale if isinstance(locale, Column) else F.lit(locale)
    point = body.rlike(PLAIN_FLOAT) & (~body.rlike(DE_GROUPED) | (locale == "en"))
    # The comma turns into a point and the grouping points go.
    return (F.when(body.rlike(PLAIN_INT) | point, body)
             .when(body.rlike(DE_DECIMAL) | body.rlike(DE_GROUPED), F.translate(body, ",.", ".")))


def parse_number(c, locale="en") -> Column:
    """A cleaned cell as a double, or NULL."""
    return plain_number(number_body(c), locale).try_cast("double")


def is_whole(number: Column) -> Column:
    return number == F.floor(number)


def number_text(plain: Column) -> Column:
    """Plain digits without idle zeros: ``007.50`` prints ``7.5``."""
    short = F.regexp_replace(plain, r"^(-?)0+(?=\d)", "$1")
    return F.regexp_replace(short, r"(\.\d*?)0+$", "$1").transform(
        lambda t: F.regexp_replace(t, r"\.$", ""))


def parse_date(c) -> Column:
    """A cleaned cell as a date in the first shape that fits and exists, or NULL."""
    c = col(c)
    tries = []
    for shape, fmt in DATE_SHAPES:
        text = c
        if fmt.endswith("yy") and not fmt.endswith("yyyy"):
            # Two-digit years from 69 on lie in the last century.
            year = F.right(c, F.lit(2)).try_cast("int")
            century = F.when(year >= 69, F.lit("19")).otherwise(F.lit("20"))
            text = F.concat(F.substring_index(c, ".", 2), F.lit("."), century, F.right(c, F.lit(2)))
            fmt = fmt.replace("yy", "yyyy")
        tries.append(F.when(c.rlike(shape), F.try_to_date(text, fmt)))
    return F.coalesce(*tries)


def iso_date(c) -> Column:
    """A native date or timestamp as ``yyyy-MM-dd`` text."""
    return F.date_format(col(c), "yyyy-MM-dd")


def percent(part, total) -> Column:
    """Share in percent with one decimal; an empty total gives 0.

    Half goes up, as in SQL ``round``.
    """
    part, total = col(part), col(total)
    return F.when(total > 0, F.round(F.lit(100.0) * part / total, 1)).otherwise(F.lit(0.0))
