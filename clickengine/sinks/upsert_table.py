"""Keyed last-write-wins table for many small batches (SK5 at scale).

``upsert_latest`` rewrites the folders of a batch's keys, so a batch of a few hundred
keys spread over all folders rewrites the whole table.  Here a batch only writes its
own rows:

    deltas/batch=<id>/    the latest row of each key of a batch, never changed afterwards
    runs/<name>/          deltas folded into one, several of them of growing size
    base/<name>/          the table as of the last full compaction, one row a key, in as many
                          files as ``bucket_rows`` rows each make, so they grow in number
    manifest/version=<v>/ one row: which base and runs count, and up to which batch the
                          deltas are in them

Readers take the newest manifest, its folders and the deltas after it, and keep each key's
row with the largest order value (merge on read); folders are immutable, so a reader
keeps its snapshot.  ``max_deltas`` deltas are folded into a run, together with the last runs
that are at most twice as large, so a row is rewritten about log(table / batch) times; all goes
into a new base when the runs hold ``ratio`` times its rows.

A replayed batch overwrites its own folder with the same rows, or, once folded, is ignored; a
crash leaves folders that no manifest names.  Nulls in the key are a key; a null order value loses
against any other.  One writer at a time, as with every streaming sink.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_MANIFEST = "base string, base_rows bigint, runs array<string>, run_rows array<bigint>, through bigint"


class UpsertTable:
    def __init__(self, spark: SparkSession, path: str, key: list[str], order: str, schema: str,
                 bucket_rows: int = 1_000_000, ratio: float = 0.5, max_deltas: int = 16):
        """``schema``: the columns of the table, with those of ``key`` and ``order`` among them."""
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order
        self.bucket_rows, self.ratio, self.max_deltas = bucket_rows, ratio, max_deltas
        self.schema = spark.createDataFrame([], schema).schema
        self.columns = self.schema.names

    # -- reading

    def read(self) -> DataFrame:
        """The latest row of each key."""
        m = self._manifest()
        return self._latest(self._folders([m["base"], *m["runs"]]).unionByName(self._deltas(m["through"]).select(*self.columns)))

    def _latest(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in self.columns if c not in self.key]
        newest = F.max_by(F.struct(*rest), F.struct(F.col(self.order).isNotNull(), self.order))
        return rows.groupBy(*self.key).agg(newest.alias("_row")).select(*self.key, "_row.*").select(*self.columns)

    def _manifest(self) -> dict:
        rows = _or_none(lambda: self.spark.read.schema(_MANIFEST + ", version bigint").parquet(f"{self.path}/manifest"))
        last = rows.orderBy(F.desc("version")).first() if rows is not None else None
        return last.asDict() if last else {"base": None, "base_rows": 0, "runs": [], "run_rows": [], "through": -1, "version": -1}

    def _folders(self, names: list) -> DataFrame:
        found = [f"{self.path}/{n}" for n in names if n]
        return self.spark.read.schema(self.schema).parquet(*found) if found else self.spark.createDataFrame([], self.schema)

    def _deltas(self, through: int) -> DataFrame:
        """The deltas after a batch; earlier folders are pruned by their name."""
        fields = self.schema.jsonValue()["fields"]
        schema = type(self.schema).fromJson({"type": "struct", "fields": fields}).add("batch", "long")
        rows = _or_none(lambda: self.spark.read.schema(schema).option("basePath", f"{self.path}/deltas").parquet(f"{self.path}/deltas"))
        return (rows if rows is not None else self.spark.createDataFrame([], schema)).where(F.col("batch") > through)

    # -- writing

    def write(self, batch: DataFrame, batch_id: int | None = None) -> None:
        """Add a batch; ``batch_id`` makes a replay harmless (default: the next one)."""
        m = self._manifest()
        if batch_id is None:
            newest = self._deltas(m["through"]).agg(F.max("batch").alias("b")).first().b
            batch_id = (m["through"] if newest is None else newest) + 1
        if batch_id > m["through"]:
            self._latest(batch.select(*self.columns)).write.mode("overwrite").parquet(f"{self.path}/deltas/batch={batch_id}")
            live = self._deltas(m["through"]).groupBy("batch").count().agg(F.count("batch").alias("n"), F.sum("count").alias("rows")).first()
            waiting = sum(m["run_rows"]) + (live.rows or 0)
            if waiting >= self.ratio * max(m["base_rows"], self.bucket_rows):
                self.compact()
            elif live.n >= self.max_deltas:
                self.compact(full=waiting >= self.ratio * m["base_rows"])

    def sink(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        """A streaming query that writes every micro-batch."""
        w = stream.writeStream.foreachBatch(lambda batch, batch_id: self.write(batch, batch_id)).option("checkpointLocation", checkpoint)
        return (w.trigger(**trigger) if trigger else w).start()

    def compact(self, full: bool = True) -> None:
        """Fold the deltas into one folder, or with ``full`` everything into a new base."""
        m = self._manifest()
        deltas = self._deltas(m["through"])
        through = deltas.agg(F.max("batch").alias("b")).first().b
        if through is None and not (full and m["runs"]):
            return
        through = m["through"] if through is None else through
        deltas = deltas.where(F.col("batch") <= through).select(*self.columns)
        runs, rows, fold = list(zip(m["runs"], m["run_rows"])), deltas.count(), []
        while runs and (full or runs[-1][1] <= 2 * rows):
            name, n = runs.pop()
            rows, fold = rows + n, [*fold, name]
        merged = self._folders(fold).unionByName(deltas)
        base = m["base"], m["base_rows"]
        if full:
            files = max(1, -(-(base[1] + rows) // self.bucket_rows))
            base = self._store("base", self._folders([base[0]]).unionByName(merged).repartition(files, *self.key))
        else:
            runs.append(self._store("runs", merged))
        row = (*base, [n for n, _ in runs], [n for _, n in runs], through)
        self.spark.createDataFrame([row], _MANIFEST).coalesce(1).write.parquet(f"{self.path}/manifest/version={m['version'] + 1}")

    def _store(self, kind: str, rows: DataFrame) -> tuple[str, int]:
        name = f"{kind}/{uuid4().hex}"
        self._latest(rows).write.parquet(f"{self.path}/{name}")
        return name, self._folders([name]).count()

    def garbage(self) -> list[str]:
        """Folders that the newest manifest doesn't name: those of deltas folded in, of earlier versions, of
        crashes.  They may go once no reader of an earlier snapshot is left."""
        m = self._manifest()
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path).select("path")
        inner = F.substring_index(F.col("path"), self.path + "/", -1)
        folder = F.substring_index(inner, "/", 2).alias("folder")
        live = [m["base"], *m["runs"], f"manifest/version={m['version']}"]
        stale = F.when(F.col("folder").startswith("deltas/"), F.substring_index("folder", "=", -1).cast("bigint") <= m["through"]) \
                 .otherwise(~F.col("folder").isin([x for x in live if x]))
        return [r.folder for r in files.select(folder).distinct().where(stale).orderBy("folder").collect()]


def _or_none(read):
    """The frame, or None where its folder isn't there yet; other trouble is an error."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
