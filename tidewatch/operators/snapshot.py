"""Latest row per key from an append-only update log.

``max_by`` over a struct is a plain aggregate: it combines map-side, so a key
with many snapshots is reduced before the shuffle instead of being sorted in
one task as a ``row_number()`` window would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(log: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep, for every key, the row with the greatest ``order_cols`` (lexicographic)."""
    rest = [c for c in log.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order_cols])
    picked = log.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
