"""Text normalisation as Spark columns. No Python runs per row."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "unknown"

# Cells that mean "nobody has answered".
EMPTY_MARKERS = (
    "", "-", "--", "---", "/", "n/a", "na", "n.a.", "k.a.", "k. a.", "keine angabe",
    "unbekannt", "unknown", "tbd", "offen", "?", "??", "???", "none", "null", "nil",
    "entfällt", "entfaellt", "leer", "x.x", ".",
)

# Words that a value map proposes as "not set" (normalised keys).
NOT_SET_MARKERS = (
    "keine", "kein", "keins", "nichts", "entfaellt", "unbekannt", "unklar",
    "offen", "nochoffen", "tbd", "nichtbekannt", "nichtzutreffend", "na", "none",
)

# Yes and no words.
YES_WORDS = ("ja", "yes", "y", "j", "true", "wahr", "x", "1", "vorhanden")
NO_WORDS = ("nein", "no", "n", "false", "falsch", "0", "nicht vorhanden")

# Letters that expand instead of losing their mark.
EXPANSIONS = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"),
              ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"))

_LATIN_BLOCKS = ((0x00A0, 0x0250), (0x1E00, 0x1F00))


def _compat_base(char: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", char)
                   if not unicodedata.combining(c))


def _accent_rule() -> tuple[str, str]:
    """Marked Latin letters and their bare form, from the Unicode tables.

    Letters that decompose into several (``ĳ``) are left alone.
    """
    source, target = [], []
    expanded = {k for k, _ in EXPANSIONS}
    for low, high in _LATIN_BLOCKS:
        for code in range(low, high):
            char = chr(code)
            base = _compat_base(char)
            if char not in expanded and base != char and len(base) == 1:
                source.append(char)
                target.append(base)
    return "".join(source), "".join(target)


_ACCENT_FROM, _ACCENT_TO = _accent_rule()


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character that counts as white space, by the Unicode tables.
WHITE_SPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip(c) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def squeeze(c) -> Column:
    """One blank for each run of white space, trimmed."""
    c = col(c)
    # Most texts hold single blanks only and need no rewriting.
    odd = c.rlike(f"  |[{WHITE_SPACE.replace(' ', '')}]")
    return strip(F.when(odd, F.regexp_replace(c, f"[{WHITE_SPACE}]+", " ")).otherwise(c))


def is_blank(c) -> Column:
    c = col(c)
    return c.isNull() | (strip(c) == "")


def norm_key(c) -> Column:
    """Join key: white space collapsed, case folded (``ß`` folds to ``ss``)."""
    return F.replace(F.lower(squeeze(c)), F.lit("ß"), F.lit("ss"))


_LONGEST_MARKER = max(map(len, EMPTY_MARKERS))


def clean_cell(c) -> Column:
    """Tidy one cell; an empty marker becomes NULL."""
    c = col(c)
    spaced = strip(F.regexp_replace(c, "[\u00a0\t ]+", " "))
    tidied = F.regexp_replace(spaced, r"\n{2,}", "\n")
    tidy = F.when(c.rlike("[\u00a0\t]|  |\n\n"), tidied).otherwise(strip(c))
    return F.when((F.length(tidy) > _LONGEST_MARKER) | ~F.lower(tidy).isin(*EMPTY_MARKERS), tidy)


def transliterate(c) -> Column:
    """Umlauts expanded, other accents dropped (Latin letters)."""
    out = col(c)
    for char, word in EXPANSIONS:
        out = F.replace(out, F.lit(char), F.lit(word))
    out = F.translate(out, _ACCENT_FROM, _ACCENT_TO)
    return F.regexp_replace(out, r"\p{Mn}+", "")


def ascii_words(c) -> Column:
    return F.lower(transliterate(c))


def slugify(c, sep: str = "_") -> Column:
    """Lower-case ASCII slug; nothing left gives ``feld``."""
    slug = F.regexp_replace(ascii_words(c), "[^a-z0-9]+", sep)
    slug = F.regexp_replace(slug, f"^{sep}+|{sep}+$", "")
    return F.coalesce(F.nullif(slug, F.lit("")), F.when(col(c).isNotNull(), F.lit("feld")))


def spelling_key(c) -> Column:
    """What two spellings of one value have in common."""
    return F.regexp_replace(ascii_words(c), "[^a-z0-9]+", "")


def parse_boolish(c) -> Column:
    """A cleaned cell as ``yes`` or ``no``, or NULL."""
    word = ascii_words(c)
    return (F.when(word.isin(*YES_WORDS), F.lit("yes"))
             .when(word.isin(*NO_WORDS), F.lit("no")))


def cut(c, width: int) -> Column:
    """Fit into ``width`` characters, marking a cut with an ellipsis."""
    c = F.coalesce(col(c).cast("string"), F.lit(""))
    return (F.when(F.length(c) <= width, c)
             .otherwise(F.concat(F.left(c, F.lit(max(1, width - 1))), F.lit("…"))))


def left_cell(c, width: int) -> Column:
    return F.rpad(cut(c, width - 1), width, " ")


def right_cell(c, width: int) -> Column:
    """A missing number prints ``n/a``, never 0."""
    shown = F.coalesce(col(c).cast("string"), F.lit("n/a"))
    return F.concat(F.lpad(cut(shown, width - 1), width - 1, " "), F.lit(" "))


def first_text(*columns) -> Column:
    """The first column that holds some text."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in columns])
