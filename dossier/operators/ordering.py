"""Positions and first-k without gathering a table or a hot key in one task."""
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dossier.checkpoints import freeze


def with_position(df: DataFrame, order: list[Column] | None = None,
                  name: str = "pos") -> DataFrame:
    """Add the 1-based position of each row in a total order over the whole table.

    Without ``order`` the rows are numbered in the order ``df`` already has.

    A plain ``row_number`` without a partition key would send every row to one task.  Here the
    table is range-sorted, frozen once, and each partition's rows get the number of rows in the
    partitions before it; only one row per partition is ever gathered.
    """
    row, part = "_row", "_part"
    # monotonically_increasing_id holds the partition in its high bits, the row in the low 33
    ordered = df.orderBy(*order) if order else df
    laid_out = freeze(ordered.withColumn(row, F.monotonically_increasing_id()))
    laid_out = (laid_out.withColumn(part, F.shiftright(row, 33))
                .withColumn(row, F.col(row).bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = laid_out.groupBy(part).agg((F.max(row) + 1).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    # one row per partition: Spark sees to its size
    return (laid_out.join(starts, part)
            .withColumn(name, F.col("_start") + F.col(row) + 1)
            .drop(part, row, "_start"))


def number_within(df: DataFrame, keys: list[str], ordinal: str, name: str) -> DataFrame:
    """1-based number of each row within its key, in the order of ``ordinal``.

    ``ordinal`` must be unique within the key; gaps of any width are fine.  A key may hold any
    share of the table: rows are range-sorted by key and ordinal and frozen once, and each
    partition's part of a key gets the number of the key's rows in the partitions before it.
    The only window is over those parts, at most one per partition and key.
    """
    row, part = "_row", "_part"
    laid_out = freeze(df.repartitionByRange(*keys, ordinal).sortWithinPartitions(*keys, ordinal)
                      .withColumn(row, F.monotonically_increasing_id()))
    laid_out = laid_out.withColumn(part, F.shiftright(row, 33))
    parts = laid_out.groupBy(*keys, part).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(part).alias("_of"), "_first",
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    match = F.col(part) == F.col("_of")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (laid_out.join(starts, match)
            .withColumn(name, (F.col("_start") + F.col(row) - F.col("_first") + 1).cast("int"))
            .select(*df.columns, name))
