"""Running numbers within a group, without holding a whole group in one task."""

from pyspark.sql import Window, functions as F

from larkspur.session import cut_lineage


def _with_offsets(rows, group, cell, order, name):
    """Number rows inside each (group, cell) and add the rows of the group's earlier cells."""
    sizes = rows.groupBy(*group, cell).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col(cell).alias("_g_cell"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
    )
    same = F.col(cell).eqNullSafe(F.col("_g_cell"))
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = F.row_number().over(Window.partitionBy(*group, cell).orderBy(*order))
    return (
        rows.join(starts, same)
        .withColumn(name, F.col("_start") + inside)
        .drop("_start", "_g_cell", *[f"_g_{g}" for g in group])
    )


def row_number_by_bucket(df, group, bucket, order, name):
    """Row number per group. ``bucket`` must not fall as the first order column rises.

    The window runs inside one bucket, so a group with a large part of all rows is spread over its
    buckets, and only bucket sizes meet per group.
    """
    rows = df.withColumn("_bucket", bucket)
    return _with_offsets(rows, group, "_bucket", order, name).drop("_bucket")


def row_number_by_range(df, group, order, name):
    """Row number per group for orders that have no natural bucket; no two rows may be equal in it.

    Rows are range-partitioned and checkpointed, so that the partition numbers used for counting and
    for numbering are the same ones even after a lost executor.
    """
    ranged = df.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id())
    return _with_offsets(cut_lineage(ranged), group, "_part", order, name).drop("_part")
