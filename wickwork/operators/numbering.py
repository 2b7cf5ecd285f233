"""Row numbers, ranks and previous rows over a whole table, without one task seeing all rows.

A window over everything, or over one very long series, moves its rows to one task. Here
rows are dealt into ordered ranges whose bounds Spark samples from the data, so neither a
shared prefix nor close values gather in one of them. The input is written before the
sample is drawn, and the ranges are written once, since a sample drawn anew could draw
other bounds. Each range is settled on its own. What it needs to know of the ranges before
it (their sizes, the last row, where the run of equal values at its border began) comes
from a summary with one row per range, as many as there are shuffle partitions; only that
summary goes through a single task, and it may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wickwork.session import staged


def _ranges() -> WindowSpec:
    """Over a summary with one row per range."""
    return Window.orderBy("_bucket")


def dealt(df: DataFrame, *order: Column | str) -> DataFrame:
    """The rows in ordered ranges, the range in `_bucket`. `df` is computed once."""
    rows = staged(df, "rows")
    return staged(rows.repartitionByRange(*order).withColumn("_bucket", F.spark_partition_id()), "ranges")


def _offset(size: str) -> Column:
    """Rows in the ranges before, over a summary of the ranges."""
    return F.coalesce(F.sum(size).over(_ranges().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def number_names(df: DataFrame, name: str, out: str) -> DataFrame:
    """1, 2, 3, ... in the order of a text column without duplicates; a NULL comes first."""
    order = F.asc_nulls_first(name)
    tagged = dealt(df, order)
    offsets = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size")).select("_bucket", _offset("_size").alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy(order))
    return (
        tagged.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, (F.col("_inside") + F.col("_offset")).cast("int"))
        .drop("_bucket", "_inside", "_offset")
    )


def rank_descending(df: DataFrame, value: str, out: str) -> DataFrame:
    """SQL rank by a number, largest first, NULLs last.

    Equal values are dealt by their other columns, so very many of them lie in several
    ranges. A range whose first values equal the last ones of the range before takes the
    rank of the place where that run of equal values began.
    """
    order = F.desc_nulls_last(value)
    rest = [c for c in df.columns if c != value]
    tagged = dealt(df, order, F.xxhash64(*rest) if rest else F.lit(0))
    # The last of a range: NULL if it has any, else its smallest value, with the rows of that value.
    per_value = tagged.groupBy("_bucket", value).agg(F.count(F.lit(1)).alias("_rows"))
    ends = per_value.groupBy("_bucket").agg(
        F.sum("_rows").alias("_size"), F.min(F.struct(F.col(value).isNotNull().alias("known"), F.col(value).alias("value"), "_rows")).alias("_last")
    ).select("_bucket", "_size", _offset("_size").alias("_offset"), "_last.known", "_last.value", "_last._rows")
    began = F.min(F.col("_offset") + F.col("_size") - F.col("_rows") + 1).over(Window.partitionBy("known", "value"))
    summary = ends.withColumn("_began", began).select(
        "_bucket", "_offset", F.lag("value").over(_ranges()).alias("_before"), F.lag("_began").over(_ranges()).alias("_began")
    )
    inside = F.rank().over(Window.partitionBy("_bucket").orderBy(order))
    goes_on = F.col("_began").isNotNull() & F.col(value).eqNullSafe(F.col("_before"))
    return (
        tagged.withColumn("_inside", inside)
        .join(F.broadcast(summary), "_bucket")
        .withColumn(out, F.when(goes_on, F.col("_began")).otherwise(F.col("_inside") + F.col("_offset")).cast("int"))
        .drop("_bucket", "_inside", "_offset", "_before", "_began")
    )


def previous_in_order(df: DataFrame, columns: dict[str, str], keys: Sequence[str], order_col: str) -> DataFrame:
    """LAG for series of any length: `columns` maps new names to columns of the row before, within each key.

    A series is dealt over as many ranges as its rows need. The last row of a range is
    carried to the next one, where it precedes the first row if that is of the same series.
    Order values are distinct within a key; a NULL comes first.
    """
    keys = list(keys)
    tagged = dealt(df, *keys, order_col)
    row = F.struct(*[F.col(column).alias(out) for out, column in columns.items()])
    series = Window.partitionBy("_bucket", *keys).orderBy(order_col)
    last_of_range = Window.partitionBy("_bucket").orderBy(*[F.desc(c) for c in (*keys, order_col)])
    ends = tagged.select("_bucket", *keys, row.alias("_row"), F.row_number().over(last_of_range).alias("_place")).where("_place = 1")
    carried = ends.select("_bucket", F.lag(F.struct(*keys, "_row")).over(_ranges()).alias("_carried"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_carried.{k}")) for k in keys), F.col("_carried").isNotNull())
    first = F.col("_place") == 1
    before = F.when(~first, F.col("_inside")).when(same, F.col("_carried._row"))
    return (
        tagged.withColumns({"_inside": F.lag(row).over(series), "_place": F.row_number().over(series)})
        .join(F.broadcast(carried), "_bucket")
        .withColumn("_before", before)
        .select(*df.columns, *[F.col(f"_before.{out}").alias(out) for out in columns])
    )
