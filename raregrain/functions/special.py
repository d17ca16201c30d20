"""The one special function Spark SQL lacks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def two_sided_normal_p(z: str) -> Column:
    """Two-sided normal tail probability; meant for one row per tested column."""
    def tail(z):
        import math
        return z.map(lambda v: None if v is None or v != v else math.erfc(abs(v) / math.sqrt(2.0)))

    import pandas as pd
    tail.__annotations__ = {"z": pd.Series, "return": pd.Series}
    return F.pandas_udf(tail, T.DoubleType())(F.col(z))
