"""Column helpers that stay inside Spark's own expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as "no number", the shape of a number, the shape of
# a date, and the shape of an amount in text.
NULL_TOKENS = ("", "na", "n/a", "null", "none", "-")
NUMBER_LETTERS = r"^[-+0-9.,eE%R$ ]+$"
NUMBER_SHAPE = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"
ISO_DATE_SHAPE = r"^[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}"
DMY_DATE_SHAPE = r"^[0-9]{2}[-/][0-9]{2}[-/][0-9]{4}"
AMOUNT_SHAPE = r"R\$\s*([\d\.]+(?:,\d+)?)"
RELATIVE_TOLERANCE = 1e-3


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def contains(text: Column | str, pattern: str) -> Column:
    """Case-folded "pattern occurs anywhere"; NULL text gives NULL."""
    return F.lower(col(text)).rlike(pattern)


def capture(text: Column | str, pattern: str, group: int = 1) -> Column:
    """The captured group, or NULL where nothing matched."""
    return F.nullif(F.regexp_extract(col(text), pattern, group), F.lit(""))


def has_word(text: Column | str, word: str) -> Column:
    r"""Whole-word match with Unicode letters, where ``\b`` splits on accents."""
    edge = r"[^\p{L}\p{N}_]"
    return F.lower(col(text)).rlike(f"(^|{edge}){word}({edge}|$)")


def swap_separators(text: Column) -> Column:
    """``1.234,5`` to ``1234.5``."""
    return F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))


def to_double(text: Column) -> Column:
    """Cast only what looks like a plain decimal; everything else is NULL."""
    return F.when(text.rlike(NUMBER_SHAPE), text.try_cast("double"))


def parse_amount(text: Column | str) -> Column:
    """A number written with either decimal sign: a comma marks the local form."""
    text = col(text)
    return F.when(text.contains(","), to_double(swap_separators(text))).otherwise(to_double(text))


def amount_in_text(text: Column | str, pattern: str = AMOUNT_SHAPE) -> Column:
    return parse_amount(capture(text, pattern))


def parse_number(text: Column | str, locale: str = "auto") -> Column:
    """A number out of a raw cell.

    ``auto`` reads both separators as dot-thousands and comma-decimal, and a
    single comma as decimal; ``br`` and ``us`` fix the reading, which is the only
    way to get ``1,234.56`` right in one and ``1.234`` right in the other.
    """
    raw = F.trim(col(text))
    bare = raw
    for sign in ("R$", "%", " "):
        bare = F.replace(bare, F.lit(sign), F.lit(""))
    if locale == "br":
        plain = swap_separators(bare)
    elif locale == "us":
        plain = F.replace(bare, F.lit(","), F.lit(""))
    elif locale == "auto":
        plain = (
            F.when(bare.contains(",") & bare.contains("."), swap_separators(bare))
            .when(F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) == 1, F.replace(bare, F.lit(","), F.lit(".")))
            .otherwise(bare)
        )
    else:
        raise ValueError(f"unknown locale {locale!r}")
    # Most text is refused at its first foreign letter, before any rewriting.
    return F.when(raw.rlike(NUMBER_LETTERS) & ~F.lower(raw).isin(*NULL_TOKENS), to_double(plain))


def parse_date(text: Column | str) -> Column:
    """A date whose first ten characters are Y-M-D or D-M-Y, else NULL."""
    head = F.translate(F.substring(F.trim(col(text)), 1, 10), "/", "-")
    return F.when(head.rlike(ISO_DATE_SHAPE), F.try_to_date(head, "yyyy-MM-dd")).when(
        head.rlike(DMY_DATE_SHAPE), F.try_to_date(head, "dd-MM-yyyy")
    )


def looks_like_date(text: Column | str) -> Column:
    return F.coalesce(parse_date(text).isNotNull(), F.lit(False))


def month_of(date: Column | str) -> Column:
    return F.date_trunc("month", col(date)).cast("date")


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def nearly_equal(a: Column | str, b: Column | str, tolerance: float = RELATIVE_TOLERANCE) -> Column:
    """Relative closeness to the larger magnitude (at least 1); missing is never close.

    A difference that is infinite or NaN comes from a value that is not finite.
    """
    a, b = col(a).cast("double"), col(b).cast("double")
    apart = F.abs(a - b)
    close = (apart < F.lit(float("inf"))) & (apart <= F.lit(tolerance) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0)))
    return F.coalesce(close, F.lit(False))


def share(part: Column, whole: Column, digits: int = 1) -> Column:
    """``part`` in percent of ``whole``; NULL for an empty whole."""
    return F.round(F.try_divide(F.lit(100.0) * part, whole), digits)


def rounded_int(x: Column) -> Column:
    """Round first, then narrow: a bare cast truncates."""
    return F.round(x).cast("bigint")
