"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(*parts: Column | str) -> Column:
    """Concatenation in which a NULL part counts as empty text; plain strings are literals."""
    return F.concat(*(
        F.lit(part) if isinstance(part, str) else F.coalesce(part.cast("string"), F.lit(""))
        for part in parts
    ))


def zero_filled(number: Column, width: int) -> Column:
    """The last `width` digits of number, filled with zeros on the left."""
    return F.right(F.concat(F.lit("0" * width), number.cast("string")), F.lit(width))
