"""Canonical keys for identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doi_key(c: Column) -> Column:
    """Letters and digits of an identifier in lower case; `''` for a blank one, NULL for NULL."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def present(key: Column) -> Column:
    """True where a canonical key identifies something."""
    return key.isNotNull() & (key != "")
