"""What stands for a text, and column names that no document has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_key(text: Column | str) -> Column:
    """128 bits that stand for a text; null is an empty one."""
    column = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, changed until ``df`` has no column that is called so, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
