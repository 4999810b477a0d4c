"""Rows dealt by key so that a task's share of them does not grow with the table.

Spark merges small shuffle partitions by their compressed bytes, and without need into no more
tasks than there are cores. The rows of a task, and the memory of its sorts and hash tables, then
grow with the table until those bytes stop it. Where several of these stand in one stage, the
number of parts comes from the number of rows instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Rows of a part, about.
ROWS = 1 << 18
#: More parts than this would cost more than tasks that spill.
MOST = 1 << 14
#: With up to so many parts a core, Spark's merging leaves a task no more than as many parts.
MERGED = 4


def parts(rows: int, each: int | None = None) -> int:
    """Parts of about ``each`` rows, by default ``ROWS``; at least one."""
    return max(1, min(MOST, -(-rows // (each or ROWS))))


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys``; counts its rows, which runs a job.

    Few rows are left to Spark, which merges small partitions. Others go to as many parts as any
    shuffle at least, as Spark deals the smaller number of two sides of a join anew.
    """
    spark = df.sparkSession
    number = parts(df.count())
    if number <= MERGED * spark.sparkContext.defaultParallelism:
        return df.repartition(*keys)
    return df.repartition(max(number, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
