"""The one metric Spark has no built-in for: the Ratcliff/Obershelp ratio.

It runs as an Arrow-batched UDF on candidate pairs that a join has already narrowed,
so the work is partitioned and shuffled by Spark.
"""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# Fixed value: a ratio at or above this counts as the same name.
NAME_MATCH_THRESHOLD = 0.6


@F.pandas_udf(DoubleType())
def name_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Similarity of two normalised names in [0, 1]; 0 when either is empty."""
    known: dict[tuple[str, str], float] = {}
    out = []
    for a, b in zip(left, right, strict=True):
        if not a or not b:
            out.append(0.0)
            continue
        if (a, b) not in known:
            known[(a, b)] = SequenceMatcher(None, a, b).ratio()
        out.append(known[(a, b)])
    return pd.Series(out, dtype="float64")
