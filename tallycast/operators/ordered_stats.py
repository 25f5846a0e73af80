"""Ordered target statistics: nominal columns of any number of categories, without leakage.

Rows stand in a seeded random order. A row's category is encoded by the mean
label of the rows of that category before it, drawn towards the overall mean, so
no row's own label reaches its feature. New rows are encoded by all rows, which
is the ordinary smoothed target encoding.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallycast.config import EncoderSpec
from tallycast.functions.scalars import nan_to_null
from tallycast.operators.guards import present, require
from tallycast.operators.target_encoding import encoded_name
from tallycast.session import materialise

# Rows of one category that one task orders, on average and at most.
BLOCK_ROWS = 100_000
PLACE, BLOCK, LABEL, CATEGORY = "_place", "_block", "_label_value", "_category"


def place(seed: int, keys: Iterable[str]) -> Column:
    """The place of a row in the random order, as 32 hexadecimal digits."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]))


def ordered_target_stats(
    df: DataFrame, columns: Iterable[str], label: str, keys: Iterable[str], spec: EncoderSpec = EncoderSpec(),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Replace each column by the smoothed mean label of earlier rows of its category.

    ``keys`` tell rows apart and decide the order together with the seed. The
    order is cut into blocks, equal but for chance. A row adds what precedes it
    in its own block to the sums of all earlier blocks of its category: a task
    sees one block of a category, however large that is. Null categories and a
    category's first row get the overall mean; rows without a label are encoded
    but count for nothing.
    """
    columns, keys = present(df, columns), list(keys)
    require(df, [label, *keys])
    if not columns:
        return df
    y = nan_to_null(F.col(label).cast("double"))
    whole = df.agg(F.count(F.lit(1)).alias("rows"), F.avg(y).alias("prior")).first()
    digits = max(1, math.ceil(math.log(max(whole["rows"], 1) / block_rows, 16)))
    prior = F.lit(whole["prior"]).cast("double")
    rows = df.withColumns({PLACE: place(spec.seed, keys), LABEL: y}).withColumn(BLOCK, F.substring(PLACE, 1, digits))
    inside = Window.partitionBy(CATEGORY, BLOCK).orderBy(PLACE, *keys).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(CATEGORY).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    for c in columns:
        # Null categories need no sums, so they are spread like values that nothing shares.
        named = rows.withColumn(CATEGORY, F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.concat(F.lit("null"), PLACE)))
        known = named.filter(F.col(c).isNotNull())
        totals = known.groupBy(CATEGORY, BLOCK).agg(F.sum(LABEL).alias("_sum"), F.count(LABEL).alias("_n"))
        before = materialise(
            totals.select(
                CATEGORY, BLOCK, F.coalesce(F.sum("_sum").over(across), F.lit(0.0)).alias("_sum"),
                F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_n"),
            )
        )
        met = named.join(before, [CATEGORY, BLOCK], "left")
        total = F.coalesce("_sum", F.lit(0.0)) + F.coalesce(F.sum(LABEL).over(inside), F.lit(0.0))
        number = F.coalesce("_n", F.lit(0)) + F.count(LABEL).over(inside)
        value = (total + F.lit(spec.smoothing) * prior) / (number + F.lit(spec.smoothing))
        if not spec.smoothing:
            value = F.when(number > 0, total / number).otherwise(prior)
        known_value = F.when(F.col(c).isNotNull(), value).otherwise(prior)
        rows = met.withColumn(encoded_name(c), known_value).drop(c, "_sum", "_n", CATEGORY)
    return rows.drop(PLACE, BLOCK, LABEL)
