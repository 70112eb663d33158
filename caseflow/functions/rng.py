"""Repeatable uniforms.

Every random choice in the package is a function of row identity and a seed, so
it does not depend on partitioning, task retries or row order.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SCALE = float(2**32)


def uniform(ids: list, seed: int | str) -> Column:
    """Uniform in [0, 1): first 32 bits of md5 over the ids and the seed, '|'-joined.

    ``ids`` are column names or Columns; each is cast to string, null as ''.
    """
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in ids
    ]
    text = F.concat_ws("|", *parts, F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(_SCALE)
