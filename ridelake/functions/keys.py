"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def key_text(col: Column, dtype=None) -> Column:
    """Text form of a key part, different for different values.  A floating
    value keeps all digits of its shortest form: in plain notation without
    trailing zeros (``12345678``, ``0.07``) where that holds them all, else in
    scientific notation."""
    text = col.cast("string")
    if isinstance(dtype, (DoubleType, FloatType)):
        size = F.abs(col)
        plain = F.regexp_replace(text.cast("decimal(38,22)").cast("string"), r"\.?0+$", "")
        text = F.when(col == 0, F.lit("0")).when((size >= 1e-5) & (size < 1e15), plain).otherwise(text)
    return F.coalesce(text, F.lit(""))


def surrogate_key(df, cols: list[str], sep: str = "-") -> Column:
    """md5 of the parts joined by ``sep``; a NULL part counts as ''.

    ``concat_ws`` alone would skip NULL parts and shift the others, so every
    part is coalesced first.  NULL and '' therefore hash alike (see
    ``hash_collisions`` for the report of such pairs).
    """
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    parts = [key_text(F.col(c), types.get(c.lower())) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))
