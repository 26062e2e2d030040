"""Last write wins per key, as a keyed table with a primary key behaves on append.

``latest_per_key`` is one aggregation: map-side partial aggregation keeps one candidate per
key per input partition before the shuffle, so a key holding a third of all rows costs one
row per map task in the exchange, not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(names) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def latest_per_key(df: DataFrame, key: str | list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple, replacing earlier rows in
    full (its NULLs included). ``order`` must be unique within a key (e.g. ts then a
    sequence number) for the result to be deterministic.
    """
    keys = [key] if isinstance(key, str) else list(key)
    values = [c for c in df.columns if c not in keys]
    rec = F.struct(*[F.col(c) for c in values])
    seq = F.struct(*_cols(order))
    out = df.groupBy(*keys).agg(F.max_by(rec, seq).alias("_rec"))
    return out.select(*keys, *[F.col("_rec")[c].alias(c) for c in values])
