"""Positions of rows inside their groups, without a window over a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.scratch import keep
from tierkit.operators._names import q


#: Column of a row's place: its task in the upper bits, its row there in the lower 33.
AT = "__at"
TASK_BITS = 33


def dealt(df: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """``df``, kept as a table, with ``AT``: a number that rises with group and
    order (nulls first), by one from row to row of a task.

    Rows are dealt to tasks by ranges of group and order and sorted there, so a
    group of any size lies in consecutive tasks.  Rows equal in all of ``order``
    are told apart by where they were read; which of them comes first has no
    meaning.
    """
    tasks = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    by = [q(group), *[q(c) for c in order], F.col("__tie")]
    rows = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(tasks, *by).sortWithinPartitions(*by)
    return keep(rows.drop("__tie").withColumn(AT, F.monotonically_increasing_id()), label)


def numbered(df: DataFrame, group: str, order: Sequence[str], label: str) -> DataFrame:
    """``df`` with ``pos`` (from 0 in the group, under ``order``, nulls first) and
    ``n`` (rows of the group), both long.  Nulls in ``group`` are one group.

    A row's place is its place in its task's stretch of the group plus the
    stretches before, of which a group has no more than there are tasks.
    ``df`` has no columns ``pos`` and ``n``.
    """
    rows = dealt(df, group, order, label)
    task = F.shiftright(AT, TASK_BITS)
    stretches = rows.groupBy(q(group).alias("__g"), task.alias("__task")).agg(
        F.min(AT).alias("__first"), F.count(F.lit(1)).alias("__rows")
    )
    of_group = Window.partitionBy("__g")
    before = F.sum("__rows").over(of_group.orderBy("__task").rowsBetween(Window.unboundedPreceding, -1))
    stretches = keep(
        stretches.select("__g", "__task", "__first", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__rows").over(of_group).alias("n")),
        f"{label}-stretches",
    )
    same = q(group).eqNullSafe(F.col("__g")) & (task == F.col("__task"))
    placed = rows.join(stretches, same)
    return placed.select(*[q(c) for c in df.columns], (F.col(AT) - F.col("__first") + F.col("__before")).alias("pos"), "n")
