"""String, JSON and array helpers (STR2-STR9, JSON1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_scalar(c, path: str) -> Column:
    """Scalar at a JSON path of a raw JSON text column; NULL when absent or unparsable."""
    return F.get_json_object(_c(c), path)


def contributing_list(pairs: list[tuple[Column, str]]) -> Column:
    """trim(concat_ws(', ', name if cond ...)) — NULL/false conditions are skipped."""
    return F.trim(F.concat_ws(", ", *[F.when(cond, F.lit(name)) for cond, name in pairs]))
