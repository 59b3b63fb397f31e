"""The one UDF of the trip domain, an Arrow twin of a native expression.

``tip_pct`` in ``columns`` is what pipelines use; the twin shows (tests) that both agree, and
(bench) what it costs.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def tip_pct_vectorized(tip: pd.Series, total: pd.Series) -> pd.Series:
    """Arrow-batched twin of ``columns.tip_pct``."""
    out = tip / total.where(total != 0) * 100
    return out.astype("float64")
