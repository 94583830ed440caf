"""SparkSession set-up shared by the library, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on.  UTC pins timestamp <-> epoch conversions;
# AQE re-plans joins and coalesces shuffle partitions at run time and splits
# skewed sort-merge join partitions.
_BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    # Column calls don't look up their place in the source: building plans is several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "clickengine", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[N]``.
    """
    # Python processes started by the JVM (workers, the streaming runner that
    # validates stateful processors) inherit its environment: put the
    # package root on PYTHONPATH before the JVM is launched.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([root, *paths])
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Runtime-settable SQL confs are re-applied on an existing session.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and "stateStore.providerClass" not in k:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a live session
                pass
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``clickengine`` importable in Python workers (stateful
    processors are pickled by reference).  Zips the package once and hands
    it to ``addPyFile``, the programmatic form of ``--py-files``; skipped when
    the workers can import it already (e.g. installed on the cluster image)."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import hashlib
    import shutil
    pkg = os.path.dirname(os.path.abspath(__file__))
    # one staging folder per package content, reused by later sessions
    digest = hashlib.sha1()
    for root, _, files in sorted(os.walk(pkg)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(root, f), "rb") as fh:
                    digest.update(f.encode() + fh.read())
    stage = os.path.join(tempfile.gettempdir(), f"clickengine-pkg-{digest.hexdigest()[:16]}")
    archive = os.path.join(stage, "clickengine.zip")
    if not os.path.exists(archive):
        os.makedirs(stage, exist_ok=True)
        tmp = shutil.make_archive(os.path.join(stage, f"clickengine-{os.getpid()}"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg))
        os.replace(tmp, archive)
    sc.addPyFile(archive)
    _SHIPPED.add(key)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment must set it to a path that the driver and all
    executors share; without it this raises.  Only for a local master (tests),
    where one machine does all the work, is an unset path filled in.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="clickengine-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df):
    """Cut lineage: write ``df`` to the shared checkpoint folder and read it
    back (reliable ``checkpoint``, never a local one).  Used between chained
    scans so a later step does not recompute the earlier shuffles, and so a
    lost executor does not force recomputation from the source."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
