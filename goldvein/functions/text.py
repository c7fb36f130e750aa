"""String cleansing functions (trim, word capitalisation, e-mail, phone)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The default word delimiters of the warehouse INITCAP function
# (whitespace and these punctuation characters). A letter that follows one of
# them starts a new word.
INITCAP_DELIMITERS = "!?@\"^#$&~_,.:;+-*%/|\\[](){}<>"


def _delimiter_class() -> str:
    escaped = "".join("\\" + c if c in "\\[]^-" else c for c in INITCAP_DELIMITERS)
    return "[\\s" + escaped + "]"


# Private-use marker inserted after delimiters while capitalising.
_MARK = "\ue000"


def initcap_words(c: Column) -> Column:
    """INITCAP with punctuation delimiters: ``mary-jane o'brien`` ->
    ``Mary-Jane O'brien``. Spark's ``initcap`` starts words after spaces
    only, so a marker plus a space is inserted after every other delimiter,
    ``initcap`` runs, and the inserted pairs are removed again. All three
    steps are code-generated built-ins (no lambda). NULL stays NULL."""
    others = _delimiter_class().replace("[\\s", "[\\t\\n\\x0B\\f\\r")
    marked = F.regexp_replace(F.lower(c), "(" + others + ")", "$1" + _MARK + " ")
    return F.regexp_replace(F.initcap(marked), _MARK + " ", "")


def unmarked(c: Column) -> Column:
    """A text that is empty where ``initcap_words`` of it is, and has blanks where that has."""
    return F.replace(c, F.lit(_MARK + " "), F.lit(""))


def clean_email(c: Column) -> Column:
    """``LOWER(TRIM(email))``."""
    return F.lower(F.trim(c))


def mvr_email(c: Column) -> Column:
    """Minimum-viable-record predicate of the silver build: not NULL and the
    lower-cased value matches ``%@%.%``."""
    return c.isNotNull() & F.lower(c).like("%@%.%")


def is_valid_email(c: Column) -> Column:
    """Valid-email predicate: not NULL, ``%@%.%``, no space, length >= 6.
    Never NULL."""
    return F.coalesce(
        c.isNotNull() & c.like("%@%.%") & ~c.like("% %") & (F.length(c) >= 6),
        F.lit(False))


def format_phone(c: Column) -> Column:
    """Digits only; 10 digits -> ``XXX-XXX-XXXX``; 11 digits -> the last ten
    formatted (first digit not checked); anything else -> the raw text."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    pattern = "([0-9]{3})([0-9]{3})([0-9]{4})"
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(F.length(digits) == 10, F.regexp_replace(digits, pattern, "$1-$2-$3"))
            .when(F.length(digits) == 11,
                  F.regexp_replace(F.right(digits, F.lit(10)), pattern, "$1-$2-$3"))
            .otherwise(c))


def identity_string(first: Column, last: Column, company: Column) -> Column:
    """``first || ' ' || last || ' ' || COALESCE(company, '')``; NULL name
    gives NULL (``concat`` propagates NULL like ``||``)."""
    return F.concat(first, F.lit(" "), last, F.lit(" "), F.coalesce(company, F.lit("")))
