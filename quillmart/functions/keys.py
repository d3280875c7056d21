"""Surrogate keys: md5 over the '-'-joined text of the key columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmart.constants import SURROGATE_NULL


def _text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(SURROGATE_NULL))


def surrogate_key(*cols) -> Column:
    """Deterministic 32-hex key; a NULL part is replaced by a fixed placeholder."""
    parts = [_text(c) for c in cols]
    if len(parts) == 1:
        return F.md5(parts[0])
    return F.md5(F.concat_ws("-", *parts))
