"""Hash-based expressions: equal on every run, partitioning and engine."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digits(text: Column, start: int, count: int) -> Column:
    """``count`` hex digits of the md5 of ``text`` as a bigint."""
    return F.conv(F.substring(F.md5(text), start, count), 16, 10).cast("bigint")


def bucket_and_sign(column: str, value: Column, buckets: int, signed: bool = True) -> tuple[Column, Column]:
    """Bucket of a whole string and its sign; null counts as the empty string."""
    keyed = F.concat(F.lit(f"{column}|"), F.coalesce(value.cast("string"), F.lit("")))
    bucket = F.pmod(_digits(keyed, 1, 8), F.lit(buckets)).cast("int")
    sign = F.lit(1)
    if signed:
        sign = F.when(F.pmod(_digits(keyed, 9, 8), F.lit(2)) == 0, 1).otherwise(-1)
    return bucket, sign


def uniform(text: Column) -> Column:
    """A number in (0, 1] that depends on ``text`` only."""
    return (_digits(text, 1, 12) + 1) / F.lit(float(16**12))


def gaussian(seed: int, *parts: Column) -> Column:
    """Standard normal draw by Box-Muller from two hash-based uniforms."""
    key = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(F.concat(key, F.lit("|u")))))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(F.concat(key, F.lit("|v"))))
