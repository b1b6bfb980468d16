"""Row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_not_null(*cols: str) -> Column:
    """True when every named column is non-null (rows with a null key are not grouped)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond
