"""Session helpers: building a session for tests and benches, shipping the
package to executors, and locating the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_PKG_DIR = os.path.dirname(os.path.abspath(__file__))
_REPO_DIR = os.path.dirname(_PKG_DIR)

#: Spark's setting that removes an action's shuffle files as soon as it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _driver_memory() -> str:
    """Local mode: three quarters of the machine's memory, at most 16g."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
        return f"{max(1, min(16, int(total * 0.75 / 2**30)))}g"
    except (ValueError, OSError, AttributeError):
        return "4g"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """Session for tests and benches. On a cluster the caller builds the
    session; everything else in the package only reads its settings."""
    pp = os.environ.get("PYTHONPATH", "")
    if _REPO_DIR not in pp.split(os.pathsep):
        os.environ["PYTHONPATH"] = _REPO_DIR + (os.pathsep + pp if pp else "")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", _driver_memory())
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable on executors (pandas UDFs and stub models
    are pickled by reference). Done once per SparkContext."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    if not sc.master.startswith("local"):
        # On a cluster the deployment ships the package (--py-files).
        sc._tessera_shipped = True
        return
    out_dir = tempfile.mkdtemp(prefix="tessera-pyfiles-")  # Spark copies it to the executors
    sc.addPyFile(shutil.make_archive(os.path.join(out_dir, "tessera"), "zip", _REPO_DIR, "tessera"))
    sc._tessera_shipped = True


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset (tests) pick one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
        conf_dir = tempfile.mkdtemp(prefix="tessera-ckpt-")  # local tests only
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def shared_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder under the shared checkpoint location, for written
    tables, streaming checkpoints and landed files."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it
    back: survives executor loss (never ``localCheckpoint``), and the plan
    restarts from a file scan. (A ``checkpoint()`` keeps its origin plan
    for statistics, and in loops the optimizer's work on those nested
    plans grows with every round.) The shuffle files behind it go with the
    write, else a loop's would all lie on disk until the driver collects its
    garbage. Tables hold texts, so they are packed with zstd."""
    spark = df.sparkSession
    path = shared_path(spark, "stage")
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if old is None else spark.conf.set(SHUFFLE_CLEANUP, old)
    return spark.read.schema(df.schema).parquet(path)


def merging(table: DataFrame) -> DataFrame:
    """``table`` as a side of a join that sorts and merges. For tables that grow
    with the input: Spark would gather one of a few MB on the driver and send it
    to all executors, and a loop does so again in every round."""
    return table.hint("merge")
