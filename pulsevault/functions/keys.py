"""Hash keys (STR1)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsevault.fixed_values import HASH_NULL_TOKEN, HASH_SEPARATOR


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols) -> Column:
    """Lower-hex MD5 of the fields cast to string, NULL replaced by a token, joined by '-'.

    Decimals print with their scale ('0.0000'), timestamps as 'yyyy-MM-dd HH:mm:ss[.ffffff]',
    booleans as 'true'/'false' — the same text DuckDB produces, so hashes agree across engines.
    """
    parts = [F.coalesce(_as_col(c).cast("string"), F.lit(HASH_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))
