"""Top-k per group that stays small whatever the group size, and report numbering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from certwatch.staging import shuffled, stage


def representatives(rows: DataFrame, group: Sequence[str], k: int, payload: Sequence[str],
                    order: Sequence[Column], name: str) -> DataFrame:
    """One row per group with ``name``: the rows any single alert of the group can need.

    An alert takes the first k rows of its group whose serial differs from its
    own. Whichever serial that is, those rows are among the first 2k once each
    serial is limited to its first k. Both limits are rank filters, which Spark
    also applies before the shuffle, so a hot group sends a few rows per task.
    """
    per_serial = Window.partitionBy(*group, "serial").orderBy(*order)
    per_group = Window.partitionBy(*group).orderBy(*order)
    kept = (
        rows.withColumn("_r", F.row_number().over(per_serial)).where(F.col("_r") <= k)
        .withColumn("_r", F.row_number().over(per_group)).where(F.col("_r") <= 2 * k)
    )
    item = F.struct(F.col("_r"), F.col("serial"), *payload)
    return kept.groupBy(*group).agg(F.array_sort(F.collect_list(item)).alias(name))


def first_k(ranked: Column, own_serial: Column, k: int) -> Column:
    """The alert's own k rows out of its group's representatives."""
    return F.slice(F.filter(ranked, lambda r: r["serial"] != own_serial), 1, k)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no",
                per: Sequence[str] = ()) -> DataFrame:
    """Consecutive numbers in ``order``, restarting for each value of ``per``.

    ``order`` must be a total order. Rows are range-partitioned, each partition
    is numbered locally and shifted by the rows before it, so no task sees more
    than its range.
    """
    sort = [*per, *[c for c in order if c not in per]]
    ranged = stage(
        df.repartitionByRange(*sort).withColumn("_part", F.spark_partition_id()), "numbered")
    # one row per (partition, restart key) run; a key is split over adjacent partitions only
    runs = ranged.groupBy("_part", *per).agg(F.count(F.lit(1)).alias("_n"))
    if per:
        before = Window.partitionBy(*per).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    else:
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("_part", *per, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_part", *per).orderBy(*sort))
    numbered = ranged.withColumn("_local", local)
    renamed = offsets.select(F.col("_part").alias("_p"), "_before",
                             *[F.col(c).alias(f"_k_{c}") for c in per])
    on = F.col("_part") == F.col("_p")
    for c in per:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return numbered.join(shuffled(renamed) if per else renamed, on).select(
        (F.col("_before") + F.col("_local")).alias(name),
        *[F.col(c) for c in df.columns])
