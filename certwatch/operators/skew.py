"""Spreading hot join keys over several tasks.

Runtime skew handling in Spark goes by bytes. A join whose work is the product
of both sides' rows per key can be skewed while its bytes are not, so such
joins are spread explicitly.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from certwatch.staging import shuffled

_LEFT, _RIGHT = "_left_split", "_right_split"


def spread_hot_keys(left: DataFrame, right: DataFrame, key: Sequence[str],
                    hot_rows: int, pairs: int) -> tuple[DataFrame, DataFrame]:
    """Add ``salt`` to both sides; joining on (*key, salt) equals joining on key.

    A hot key becomes a grid: its right rows are dealt over columns of ``hot_rows`` at
    most on average, its left rows over as many lines as keep each cell near ``pairs`` row
    pairs. A row is repeated along its line or column only. Other keys keep salt 0. Neither
    the number of hot keys nor that of splits is limited, so their table is not broadcast
    by force: its size decides.
    """
    rows = F.count(F.lit(1))
    columns = F.greatest(F.lit(1), F.ceil(F.col("_r") / hot_rows))
    lines = F.greatest(F.lit(1), F.ceil(F.col("_l") * F.col("_r") / (columns * pairs)))
    hot = (
        right.groupBy(*key).agg(rows.alias("_r"))
        .join(shuffled(left.groupBy(*key).agg(rows.alias("_l"))), [*key])
        .where((F.col("_r") > hot_rows) | (F.col("_l") * F.col("_r") > pairs))
        .select(*key, lines.cast("int").alias(_LEFT), columns.cast("int").alias(_RIGHT))
    )

    def dealt(df: DataFrame, own: str, other: str, salt: Callable[[Column, Column], Column]) -> DataFrame:
        place = F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col(own)).cast("int"), F.lit(0))
        along = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))
        return (df.join(hot, [*key], "left").withColumn("_place", place).withColumn("_along", along)
                .withColumn("salt", salt(F.col("_place"), F.col("_along"))).drop("_place", "_along", _LEFT, _RIGHT))

    def cell(line: Column, column: Column) -> Column:
        return F.coalesce(line.cast("long") * F.col(_RIGHT) + column, F.lit(0).cast("long"))

    return dealt(left, _LEFT, _RIGHT, cell), dealt(right, _RIGHT, _LEFT, lambda place, along: cell(along, place))
