"""Training samples that are bounded by rows and by bytes of text."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A text of more than this part of the bound in bytes doesn't train.
LONGEST = 16


def bounded(rows: DataFrame, key: Column, max_rows: int, max_bytes: int) -> DataFrame:
    """The rows of ``rows`` with the smallest ``key``: as many, in its order, as
    hold at most ``max_rows`` rows and ``max_bytes`` bytes of ``text`` (UTF-8).

    Texts of over a 16th of ``max_bytes`` are passed over, so that one of them
    can't take the whole sample. Ties are settled by length, then by the other
    columns. The lengths are looked at first (two numbers for at most
    ``max_rows`` rows reach the driver), so no task and not the driver holds
    more text than the bounds allow for each.
    """
    keyed = (rows.withColumns({"_key": key, "_bytes": F.coalesce(F.octet_length(F.col("text")), F.lit(0))})
             .filter(F.col("_bytes") <= max_bytes // LONGEST))
    sizes = [r["_bytes"] for r in keyed.select("_key", "_bytes").orderBy("_key", "_bytes").limit(max_rows).collect()]
    n = int(np.searchsorted(np.cumsum(sizes, dtype=np.int64), max_bytes, side="right"))
    return keyed.orderBy("_key", "_bytes", *rows.columns).limit(n).drop("_key", "_bytes")
