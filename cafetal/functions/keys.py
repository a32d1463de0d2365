"""Serialized composite keys ``a|b|c``; a NULL part becomes an empty string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cafetal.functions.numeric import _c


def _plain(text: Column) -> Column:
    """A number's text without an exponent: coordinates near zero are written 0.0005, not 5.0E-4."""
    fixed = F.regexp_replace(F.format_string("%.6f", text.try_cast("double")), "0+$", "")
    return F.when(text.contains("E-"), fixed).otherwise(text)


def composite_key(*parts) -> Column:
    pieces = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append(F.coalesce(_plain(_c(p).cast("string")), F.lit("")))
    return F.concat(*pieces)
