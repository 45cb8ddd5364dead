"""Deterministic sampling: a row falls on the same side in every run, replay and engine."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 1 << 32


def bucket_sql(salt: str, *cols: str) -> str:
    """The first 32 bits of the MD5 of salt and columns, as a number."""
    digest = f"md5(concat_ws('|', '{salt}', {', '.join(cols)}))"
    return f"bigint(conv(substring({digest}, 1, 8), 16, 10))"


def sampled(rate: float, salt: str, *cols: str) -> Column:
    """True for a ``rate`` share of rows, chosen by their identifying columns.

    The share is rounded up to a multiple of 2**-32, so a rate above zero never becomes none.
    """
    if not 0 <= rate <= 1:
        raise ValueError("rate must lie between 0 and 1")
    return F.expr(f"{bucket_sql(salt, *cols)} < {math.ceil(rate * _STEPS)}")
