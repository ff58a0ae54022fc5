"""Dense positions of rows inside groups, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from curveloom.llm.tables import stored

#: monotonically increasing ids hold the task above this bit
TASK_BITS = 33


def positions(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``idx`` (0, 1, … within its group, by ``order``, NULL first) and ``n`` (rows of the group).

    ``group`` must not be NULL.  A range sort spreads any group over many tasks; what is counted over
    the tasks is one row for each group in each task.  Rows that tie in ``order`` stay together in one
    task, so end it with a column that tells them apart.  ``df`` is read twice: store it first if it is dear.
    """
    placed = stored(
        df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "placed",
    )
    task = F.shiftrightunsigned("_at", TASK_BITS)
    by_task = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(
        placed.groupBy(task.alias("_task"), group).agg(F.min("_at").alias("_first"), F.count("*").alias("_held"))
        .withColumn("_before", F.coalesce(F.sum("_held").over(by_task), F.lit(0)))
        .withColumn("n", F.sum("_held").over(Window.partitionBy(group))),
        "runs",
    )
    return (
        placed.withColumn("_task", task).join(runs, ["_task", group])
        .withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first"))
        .drop("_task", "_at", "_first", "_held", "_before")
    )
