"""Surrogate keys over several columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def surrogate_key(*columns: str, hashed: bool = False, null_token: str = "_null_") -> Column:
    """The columns joined by ``-``, readable as it is or as an md5 digest. A token stands
    for NULL, so that (NULL, 'a') and ('a', NULL) differ."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(null_token)) for c in columns]
    key = F.concat_ws("-", *parts)
    return F.md5(key) if hashed else key
