"""Rows handled by the largest window task: plain per-key window vs the
skew-safe ordered scan, on generated rows where one key holds a third.

    python tools/skew_check.py [rows] [partitions]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickengine.operators.ordered import arrival_bucket, ordered_scan  # noqa: E402
from clickengine.session import get_session  # noqa: E402


def main(n: int, parts: int) -> None:
    spark = get_session("local[8]", parts, extra={
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # seq = arrival order; every third row belongs to the hot key 0
    df = spark.range(n).select(F.col("id").alias("seq"),
                               F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 100_000 + 1).alias("k"))
    w = Window.partitionBy("k").orderBy("seq")
    plain = df.withColumn("rn", F.row_number().over(w))
    width = max(n // (4 * parts), 1)
    scan = ordered_scan(df, ["k"], ["seq"], arrival_bucket("seq", width), hot_rows=width)
    out = {"rows": n, "partitions": parts}
    for name, res in [("plain_window", plain), ("ordered_scan", scan)]:
        t = time.perf_counter()
        # reference rn so the window is kept; the partition id is the window task
        sizes = res.where(F.col("rn") > 0).groupBy(F.spark_partition_id().alias("p")).count()
        mx = sizes.agg(F.max("count")).first()[0]
        out[name] = {"max_rows_per_task": mx, "share_of_rows": round(mx / n, 4),
                     "sec": round(time.perf_counter() - t, 2)}
    print(json.dumps(out))


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000, int(sys.argv[2]) if len(sys.argv) > 2 else 64)
