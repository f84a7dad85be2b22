"""Unit normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_litres(col, strict: bool = True) -> Column:
    """``'500ml'`` -> 0.5, ``'1.5lt'`` -> 1.5, null -> null.

    The unit is the last two characters and the number everything before them.
    Any other unit raises (``strict``) or yields null.
    """
    c = F.col(col) if isinstance(col, str) else col
    unit = F.substring(c, -2, 2)
    number = F.substring(c, F.lit(1), F.length(c) - 2).cast("double")
    other = F.raise_error(F.concat(F.lit("Unknown unit: "), unit)) if strict else F.lit(None)
    return (
        F.when(c.isNull(), F.lit(None).cast("double"))
        .when(unit == "ml", number / 1000.0)
        .when(unit == "lt", number)
        .otherwise(other.cast("double"))
    )
