"""String helpers (STR1, STR2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def csv_field(value: Column | str, index: int, sep: str = ",") -> Column:
    """STR1: 0-based positional field of a delimited line (NULL if missing)."""
    return F.try_element_at(F.split(_c(value), sep if sep != "." else r"\."), F.lit(index + 1))


def topic_db_table(topic: Column | str) -> tuple[Column, Column]:
    """STR2: '<server>.<db>.<table>' -> (db, table)."""
    t = _c(topic)
    return F.split_part(t, F.lit("."), F.lit(2)), F.split_part(t, F.lit("."), F.lit(3))
