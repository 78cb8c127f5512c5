"""Path extraction from semi-structured (JSON text) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.functions.util import as_col

_INTEGRAL = {"tinyint", "smallint", "int", "integer", "bigint", "long"}


def extract_path(c, path: str, type_name: str) -> Column:
    """``doc:path::type``: the value at a JSON path cast to ``type_name``;
    a missing path gives NULL. Integral targets round a fractional value
    half-up instead of truncating it."""
    v = F.parse_json(as_col(c))
    if type_name.lower() in _INTEGRAL:
        # one rounding, from the value as written: digits beyond 18 places are no tie
        return F.round(F.variant_get(v, path, "decimal(38,18)")).cast(type_name)
    return F.variant_get(v, path, type_name)
