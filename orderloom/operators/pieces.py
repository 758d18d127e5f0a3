"""Split hot keys into pieces of their time order, so that no task gets a whole hot key.

The rows of the hot keys are dealt out by range of (key, order, a hash of row and task): a piece
is one such range. Their number follows from the number of rows; a key may have any number
of pieces, and even rows of one key and one instant are spread. Pieces too small to be worth a task
are cut several at a time, from a range that is sorted. A task that runs again deals its
rows alike. The pieces are written once, so that every later read sees the same ones.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import run_dir

# Rows of one key that a single task may sort.
MAX_TASK_ROWS = 4_000_000
# Ranges come from a sample, so they are cut somewhat smaller than allowed.
MARGIN = 1.5
# Rows that are worth a task of their own, beyond a task for every shuffle partition.
WORTH_ROWS = 250_000


def hot_keys(keys: DataFrame, max_task_rows: int) -> DataFrame:
    """The keys (the only column) with more than ``max_task_rows`` rows, stored.

    Counting combines on the map side. At most one key per ``max_task_rows`` rows is hot.
    """
    (key,) = keys.columns
    counts = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_task_rows)
    path = run_dir(keys.sparkSession, "hot_keys")
    counts.write.parquet(path)
    return keys.sparkSession.read.schema(counts.schema).parquet(path)


def cut(rows: DataFrame, order: list[str], max_task_rows: int) -> DataFrame:
    """``rows`` with ``piece``: ranges of ``order``, ascending, of about equal size; stored."""
    spark = rows.sparkSession
    count = rows.count()
    pieces = max(1, math.ceil(MARGIN * count / max_task_rows))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = min(pieces, max(partitions, math.ceil(count / WORTH_ROWS)))
    # Equal rows differ by their task, and a task that runs again gives the same numbers.
    spread = F.xxhash64(*rows.columns, F.spark_partition_id())
    ranged = rows.withColumn("_spread", spread).repartitionByRange(tasks, *order, "_spread")
    piece = F.spark_partition_id().cast("bigint")
    if tasks < pieces:
        # Row numbers start at a multiple of 2**33 in every task: no piece lies in two ranges.
        ranged = ranged.sortWithinPartitions(*order, "_spread")
        piece = F.expr(f"monotonically_increasing_id() div {int(max_task_rows)}")
    ranged = ranged.withColumn("piece", piece).drop("_spread")
    path = run_dir(spark, "pieces")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)
