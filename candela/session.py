"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are UTC instants (the session zone is pinned), ANSI
# stays on (casts of untrusted text go through try_cast), AQE re-plans joins and coalesces
# shuffle partitions at runtime and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Bytes of an Arrow batch on its way to a Python worker: rows may be large (texts, packed groups).
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Archive CSV lines with too many or too few fields must land whole in the rescue column;
    # with CSV column pruning the parser never sees the unrequested fields and cannot tell.
    "spark.sql.csv.parser.columnPruning.enabled": "false",
    # Streaming state (dedup keys, open windows) in RocksDB: off-heap, spills to local disk,
    # checkpointed with the query, so large key sets do not live in executor heaps.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "candela", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the base settings.

    On a cluster pass ``master=None`` and size ``shuffle_partitions`` to the data
    (about 128-256 MB of shuffle input per partition); tests use local[*] and 8.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", os.environ.get("CANDELA_DRIVER_MEMORY", "16g"))
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if spark.conf.isModifiable(k):  # static settings of a session that already existed stay
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``candela`` importable in executor Python workers (the Arrow-batched functions are
    pickled by reference): zip the package once per application and register it with
    ``addPyFile``; Spark copies it to every executor, including ones started later."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    import candela
    pkg_dir = os.path.dirname(os.path.abspath(candela.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="candela-pyfiles-"), "candela.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable base settings to a session someone else built (static
    settings such as the UI stay as they are)."""
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A cluster sets it to shared storage; only where it is unset and the master is local (tests, local runs) do we
    choose one ourselves: elsewhere a temporary folder would be a different disk on each node.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith(("local[", "local-")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        path = tempfile.mkdtemp(prefix="candela-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder, for stream state and hand-over tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _status(spark: SparkSession, path: str) -> list:
    """File statuses of a path through Spark's file system layer; none where it does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return list(fs.listStatus(p)) if fs.exists(p) else []


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a stored table has anything in it (hidden files apart)."""
    return any(not x.getPath().getName().startswith(("_", ".")) for x in _status(spark, path))


def write_finished(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote a folder came to its end."""
    return any(x.getPath().getName() == "_SUCCESS" for x in _status(spark, path))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    return sorted(x.getPath().getName() for x in _status(spark, path) if x.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder another name through Spark's file system layer; what had that name goes."""
    at, to = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(to, True)
    if not fs.rename(at, to):
        raise OSError(f"{source} could not become {target}")


def stamp(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of a folder's entries: it changes when a table in it is written anew."""
    return tuple(sorted((x.getPath().getName(), x.getLen(), x.getModificationTime()) for x in _status(spark, folder)))
