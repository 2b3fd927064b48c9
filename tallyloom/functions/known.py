"""Known or not: missing, null, blank and ``unknown`` are one and the same."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import UNKNOWN, WHITE_SPACE, col, strip

# Nothing or UNKNOWN, in any case and within white space. Most texts fail at their first letter, which is much cheaper than
# to trim and fold them. The Kelvin sign is a capital k, too.
_SPACE = f"[{WHITE_SPACE}]*+"
_NO_ANSWER = rf"\A{_SPACE}(?:{''.join(f'[{a}{a.upper()}]' for a in UNKNOWN).replace('kK', 'kK\u212a')}{_SPACE})?\z"


def is_known(c) -> Column:
    """An actual answer in a text column. Never NULL itself."""
    return F.coalesce(~col(c).rlike(_NO_ANSWER), F.lit(False))


def any_known(array) -> Column:
    """A list is known when at least one of its elements is."""
    return F.coalesce(F.exists(col(array), lambda v: is_known(v)), F.lit(False))


def as_code(c) -> Column:
    """A coded value or the word ``unknown``; never NULL."""
    c = col(c)
    return F.when(is_known(c), strip(c)).otherwise(F.lit(UNKNOWN))


def as_text(c) -> Column:
    c = col(c)
    return F.when(is_known(c), c)


def as_number(c) -> Column:
    """A whole number or NULL; ``unknown`` does not become 0."""
    return col(c).try_cast("bigint")


def joined_codes(array) -> Column:
    """A list of codes as one sorted, comma-joined text; an empty list is unknown."""
    array = col(array)
    codes = F.array_sort(F.transform(array, lambda v: as_code(v)))
    return (F.when(F.size(array) > 0, F.array_join(codes, ", "))
             .when(array.isNotNull(), F.lit(UNKNOWN)))
