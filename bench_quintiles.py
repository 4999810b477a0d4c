"""Time quintiles of three measures: cuts by counting, positions in ranges, ``ntile``.

``python bench_quintiles.py 200000 2000000`` prints a JSON line per number of rows, the
second run of each. ``BENCH_CPUS`` chooses the cores, ``BENCH_NTILE=0`` leaves ``ntile`` out.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from souk.functions.exact import cents
from souk.plans.rank import ranked, tile
from souk.plans.select import cuts, part
from souk.plans.session import session
from souk.plans.tables import materialize, owned

MEASURES = ["recency_days", "frequency", "monetary"]


def people(spark, rows: int) -> DataFrame:
    draw = F.xxhash64("id")
    return spark.range(rows).select(
        F.col("id").alias("person"),
        F.pmod(draw, F.lit(700)).cast("int").alias("recency_days"),
        F.pmod(F.xxhash64(draw), F.lit(5)).alias("frequency"),
        (F.pmod(F.xxhash64(draw, F.lit(1)), F.lit(10**7)) / 100).cast("decimal(20,2)").alias("monetary"),
    )


def by_position(frame: DataFrame) -> DataFrame:
    bucket = tile(5)
    return ranked(frame, "person", MEASURES).groupBy("person").agg(
        *(F.max(F.when(F.col("measure") == n, bucket)).alias(m) for n, m in enumerate(MEASURES))
    )


def by_cuts(frame: DataFrame) -> DataFrame:
    values = [F.col("recency_days"), F.col("frequency"), cents("monetary")]
    found = cuts(frame, "person", values, 5)
    return frame.select("person", *(
        part(found, n, v, "person").alias(MEASURES[n]) for n, v in enumerate(values)))


def by_ntile(frame: DataFrame) -> DataFrame:
    return frame.select("person", *(
        F.ntile(5).over(Window.orderBy(m, "person")).alias(m) for m in MEASURES))


def main(sizes: list[int]) -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    plans = {"cuts": by_cuts, "positions": by_position}
    if os.environ.get("BENCH_NTILE", "1") != "0":
        plans["ntile"] = by_ntile
    with tempfile.TemporaryDirectory(prefix="souk-bench-") as scratch:
        spark = session("souk-quintiles", f"local[{cpus}]", **{
            "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "20g", "spark.checkpoint.dir": scratch,
        })
        spark.sparkContext.setLogLevel("ERROR")
        for rows in sizes:
            seconds = {}
            with owned(spark):
                frame = materialize(people(spark, rows))
                for name, plan in plans.items():
                    for _ in range(2):
                        start = time.perf_counter()
                        with owned(spark):
                            plan(frame).write.format("noop").mode("overwrite").save()
                        seconds[name] = round(time.perf_counter() - start, 1)
            print(json.dumps({"rows": rows, "seconds": seconds}), flush=True)
        spark.stop()


if __name__ == "__main__":
    main([int(a) for a in sys.argv[1:]] or [200_000, 2_000_000, 8_000_000])
