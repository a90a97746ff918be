"""Session helpers: a local session for tests/bench, and lineage cutting that
uses the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8,
                  app: str = "floe") -> SparkSession:
    """Session for tests and the bench: UI off, AQE on, UTC, zstd output."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or the context's setting). Only a local
    master may fall back to a fresh temporary folder; on a cluster an unset
    folder is an error, because executors cannot share a machine-local path.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
    conf = tempfile.mkdtemp(prefix="floe-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    spark.conf.set("spark.checkpoint.dir", conf)
    return conf


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a zstd parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage where a large intermediate is read more than once: a lost
    executor re-reads the table instead of recomputing the upstream plan, and
    later passes that need few columns read only those (columnar pruning).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def _scratch_root(spark: SparkSession) -> str:
    """This application's own folder under the shared checkpoint folder."""
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext
        app = spark.conf.get("spark.app.id", "session")
    return f"{checkpoint_dir(spark).rstrip('/')}/floe-out/{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's scratch folder (for sinks in queries)."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete the tables that this application wrote to its scratch folder; other applications' tables stay.

    Frames that still read them (every result that ``materialize`` cut) are unusable afterwards, so it
    is the caller's last step, when all results are written.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once per context), for functions that run inside tasks.

    A package that is installed on the workers, or sent with ``--py-files``, does as well.
    """
    sc = spark.sparkContext
    if getattr(sc, "_floe_shipped", False):
        return
    root = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="floe-zip-")) / "floe.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._floe_shipped = True
