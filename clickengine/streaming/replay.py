"""Replay of a stored event table as a stream (SC9) and a small driver for
running a streaming query slice by slice: the harness of the batch = stream
tests, and a way to run a streaming form over a stored table.

Each pushed slice is appended to a parquet folder that a file stream source
reads; ``run`` then starts the query from its checkpoint with
``trigger(availableNow=True)`` and waits for it.  Every slice therefore is
one (or more) micro-batches *and* a restart from the checkpoint, which is
what the restart tests (ST14, ST15) need.  Results go through
``foreachBatch`` into one parquet folder per batch id, overwritten on replay,
so a re-run batch never duplicates output.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickengine.session import checkpoint_dir

# Reserved key of the end-of-input row: a bounded source in the
# reference engine ends with an infinite watermark; Spark's does not, so the
# last windows / timers are flushed by one far-future row, filtered out after.
SENTINEL_KEY = "__end_of_input__"
SENTINEL_ID = -(1 << 62)


def slice_by(df: DataFrame, order_col: str, slices: int) -> list[DataFrame]:
    """Split a table into ``slices`` arrival ranges of ``order_col`` (the
    bounds come from one aggregate; the slices are lazy filters).  Rows without
    an order value come first."""
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) / slices if hi is not None and hi > lo else 1
    out = []
    for i in range(slices):
        a = lo + step * i if hi is not None else None
        cond = F.col(order_col).isNull() if hi is None and i == 0 else F.lit(False)
        if hi is not None:
            cond = F.col(order_col).isNull() | (F.col(order_col) >= a) if i == 0 else F.col(order_col) > a
            if i < slices - 1:
                cond = cond & (F.col(order_col).isNull() | (F.col(order_col) <= lo + step * (i + 1)))
        out.append(df.where(cond))
    return out


class StreamReplay:
    """Drive a streaming query over slices of a table."""

    def __init__(self, spark: SparkSession, schema: T.StructType, workdir: str | None = None):
        self.spark = spark
        self.schema = schema
        base = workdir or os.path.join(checkpoint_dir(spark), f"replay-{uuid.uuid4().hex[:12]}")
        self.src = os.path.join(base, "source")
        self.ckpt = os.path.join(base, "checkpoint")
        self.out = os.path.join(base, "output")
        self.batches: list[int] = []

    def source(self, max_files: int | None = None) -> DataFrame:
        os.makedirs(self.src, exist_ok=True) if "://" not in self.src else None
        r = self.spark.readStream.schema(self.schema)
        if max_files:
            r = r.option("maxFilesPerTrigger", max_files)
        return r.parquet(self.src)

    def push(self, batch: DataFrame) -> None:
        batch.select(*[f.name for f in self.schema.fields]).write.mode("append").parquet(self.src)

    def run(self, result: DataFrame, output_mode: str = "append", timeout: float = 300) -> None:
        """Process everything pushed so far, then stop.  ``availableNow``
        ends by itself for event-time queries; processing-time stateful
        queries keep issuing empty batches, so the query is also stopped once
        it is idle (no data left and its last batches read no rows).  A query
        that fails raises its error, one that isn't done in time a TimeoutError:
        part of the data never passes for all of it."""
        import time
        out = self.out
        seen = self.batches

        def write(batch_df: DataFrame, batch_id: int):
            batch_df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
            seen.append(batch_id)

        q = (result.writeStream.outputMode(output_mode).foreachBatch(write)
             .option("checkpointLocation", self.ckpt).trigger(availableNow=True).start())
        try:
            deadline = time.time() + timeout
            while q.isActive:
                if time.time() > deadline:
                    raise TimeoutError(f"the replay wasn't done after {timeout} s")
                q.awaitTermination(0.5)
                prog = q.recentProgress
                idle = len(prog) >= 3 and all(p.get("numInputRows", 0) == 0 for p in prog[-2:])
                if idle and not q.status.get("isDataAvailable", False):
                    break
        finally:
            q.stop()
        if q.exception() is not None:
            raise q.exception()

    def results(self) -> DataFrame | None:
        """What the batches wrote, None before the first one."""
        return self.spark.read.parquet(self.out) if self.batches else None


def sentinel_row(df: DataFrame, key: str, ts: str, far: str = "2200-01-01 00:00:00") -> DataFrame:
    """A one-row frame with ``df``'s schema: the reserved key at a far-future
    time (inside the pandas nanosecond range, for stateful processors), all
    other columns null (S4).  Push it as the last slice."""
    spark = df.sparkSession
    fields = []
    for f in df.schema.fields:
        if f.name == key:
            v = SENTINEL_KEY if isinstance(f.dataType, T.StringType) else SENTINEL_ID
            fields.append(F.lit(v).cast(f.dataType).alias(f.name))
        elif f.name == ts:
            fields.append(F.lit(far).cast(f.dataType).alias(f.name))
        else:
            fields.append(F.lit(None).cast(f.dataType).alias(f.name))
    return spark.range(1).select(*fields)


def is_sentinel(key: str) -> "F.Column":
    c = F.col(key).cast("string")
    return (c == SENTINEL_KEY) | (c == str(SENTINEL_ID))
