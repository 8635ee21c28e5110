"""Skew-safe first-k rows per group.

``row_number() over (partition by key order by ...) <= k`` is planned by
Catalyst with a *partial* ``WindowGroupLimit`` before the shuffle: every map
task sorts its own rows and sends at most k rows per key, so even a key that
holds a third of the data reaches the final window as <= k rows per map task
(a map-side combine for top-k).  ``test_plans.py`` checks that the partial
limit is in the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int,
                      rank_col: str = "rank") -> DataFrame:
    """Rows ranked 1..k per ``keys`` by ascending ``order`` (give a unique
    order for a stable result)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
