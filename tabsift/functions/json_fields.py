"""JSON documents held in a string column, addressed by path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import col


def path(*steps: str | int) -> str:
    """``path("body", "E-mail", 0)`` is ``$['body']['E-mail'][0]``."""
    return "$" + "".join(f"[{s}]" if isinstance(s, int) else f"['{s}']" for s in steps)


def value(doc: Column | str, *steps: str | int) -> Column:
    """The scalar at a path; a single ``$…`` step is taken as a path."""
    where = steps[0] if len(steps) == 1 and str(steps[0]).startswith("$") else path(*steps)
    return F.get_json_object(col(doc), where)


def body(doc: Column | str, *steps: str | int) -> Column:
    """A field of the message payload, which arrives below ``body``."""
    return value(doc, "body", *steps)


def default_if_missing(x: Column, default) -> Column:
    """Only NULL is replaced: zero and the empty text are values."""
    return F.coalesce(x, F.lit(default))


def default_if_blank(x: Column, default) -> Column:
    """NULL, the empty text and zero are all replaced."""
    blank = (F.trim(x.cast("string")) == "") | F.coalesce(x.try_cast("double") == 0, F.lit(False))
    return F.when(x.isNull() | blank, F.lit(default)).otherwise(x)


def one_of_list(doc: Column | str, *steps: str | int, dtype: str = "bigint") -> Column:
    """``[3]`` to ``3``: index the list first, a direct cast would be NULL."""
    return value(doc, *steps, 0).try_cast(dtype)
