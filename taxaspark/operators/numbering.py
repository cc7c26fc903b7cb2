"""Dense global numbers without a window over everything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from taxaspark.storage import materialize


def dense_ids(rows: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """``rows`` with ``name``: their place in ``order``, from ``start``.

    Rows are sorted by range, numbered within partitions, and each partition starts after the sum of those before; only one
    number a partition meets in one place. Equal rows take any order among
    themselves. The rows are written to the shared folder.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = ranged.withColumn("__m", F.monotonically_increasing_id())
    # written, as another evaluation may draw other ranges
    marked = materialize(marked, name).withColumns({"__p": F.shiftright("__m", 33), "__r": F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = marked.groupBy("__p").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = marked.join(F.broadcast(sizes.select("__p", before.alias("__b"))), "__p")  # a row for each partition
    return out.withColumn(name, (F.col("__b") + F.col("__r") + start).cast("bigint")).drop("__m", "__p", "__r", "__b")


def prefix_numbers(items: DataFrame, group: str, group_order: str, item_order: str, name: str, start: int = 1) -> DataFrame:
    """``items`` with ``name``: dense numbers over groups in ``group_order``, and in each group by ``item_order``.

    ``group_order`` is one value a group. Counts of groups are summed up, so items are numbered group by group, never in one task.
    """
    sizes = items.groupBy(group, group_order).agg(F.count("*").alias("__n"))
    ordered = dense_ids(sizes, [group_order, group], "__g")
    # sums over blocks of groups, then within blocks: no window holds all groups
    block = F.floor(F.col("__g") / 4096)
    blocks = ordered.groupBy(block.alias("__k")).agg(F.sum("__n").alias("__s"))
    ahead = F.coalesce(F.sum("__s").over(Window.orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum("__n").over(Window.partitionBy("__k").orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ordered.withColumn("__k", block).join(blocks.select("__k", ahead.alias("__a")), "__k").select(group, (F.col("__a") + within).alias("__b"))
    place = F.row_number().over(Window.partitionBy(group).orderBy(item_order))
    return items.withColumn("__r", place).join(starts, group).withColumn(name, (F.col("__b") + F.col("__r") - 1 + start).cast("bigint")).drop("__r", "__b")
