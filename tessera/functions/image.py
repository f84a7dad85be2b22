"""Image helpers (F8)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


@F.pandas_udf(BinaryType())
def grayscale(data: pd.Series, channels: pd.Series) -> pd.Series:
    """F8: BGR(A) bytes of Spark's image source -> 8-bit gray bytes with the fixed-point
    ``0.114 B + 0.587 G + 0.299 R`` weights of the common BGR-to-gray conversion."""
    out = []
    for buf, nc in zip(data, channels):
        a = np.frombuffer(bytes(buf), dtype=np.uint8).reshape(-1, int(nc)).astype(np.int64)
        if nc == 1:
            out.append(bytes(buf))
            continue
        g = (a[:, 2] * 4899 + a[:, 1] * 9617 + a[:, 0] * 1868 + 8192) >> 14
        out.append(g.astype(np.uint8).tobytes())
    return pd.Series(out)
