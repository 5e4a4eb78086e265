"""Session construction and the shared scratch location.

Every job that must cut lineage or stage files writes below the folder named
by ``spark.checkpoint.dir``.  On a cluster that folder is shared storage set
by the operator of the cluster; we only invent one (a fresh temporary folder)
when the session runs in local mode and nothing is configured, as in tests.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

#: HotSpot never compiles methods of more bytes of code than this.  A stage over
#: the 57 to 71 columns of a transaction makes longer ones, which would run
#: interpreted; above this limit Spark takes shorter methods, one per operator.
HUGE_METHOD, HUGE_METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000

# Session settings shared by tests, the bench and the examples.
DEFAULT_CONF = {
    HUGE_METHOD: str(HUGE_METHOD_BYTES),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "cardlens", extra: dict | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """A session with ``DEFAULT_CONF``.  ``shuffle_partitions`` overrides the
    cluster's setting (see ``size_shuffles``).  ``event_log_dir`` writes Spark's
    event log there (stage and task times, read offline; no UI is started)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if event_log_dir:
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compile_wide_rows(spark: SparkSession) -> None:
    """Have stages over wide rows compiled (see ``HUGE_METHOD``) in a session
    that was built elsewhere; a lower limit is left.  This changes no result."""
    if int(spark.conf.get(HUGE_METHOD)) > HUGE_METHOD_BYTES:
        spark.conf.set(HUGE_METHOD, str(HUGE_METHOD_BYTES))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session first (``spark.checkpoint.dir`` or a directory set
    with ``setCheckpointDir``).  Only a local-mode session without one gets a
    fresh temporary folder; a cluster session without one is an error,
    because a machine-local folder is not visible to the executors.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(for example an hdfs:// or s3a:// folder) before running this job")
        root = tempfile.mkdtemp(prefix="cardlens-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 128 * 1024 * 1024,
                           minimum: int = 8) -> int:
    """Partition count that keeps each shuffle partition near ``target_bytes``.

    AQE coalesces small partitions at run time, so erring high is cheap;
    erring low spills.
    """
    return max(minimum, -(-int(input_bytes) // target_bytes))


def path_size(spark: SparkSession, path: str) -> int:
    """Total size in bytes of the files below ``path`` (Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(jpath).getLength())


def put_if_absent(spark: SparkSession, path: str) -> bool:
    """Create the empty file ``path``; False if it exists already.  Of several
    callers at once one wins, wherever the file system creates files without
    overwriting in one step (local disks, HDFS, object stores with conditional
    writes)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(jpath.getParent())
    if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
        return bool(jvm.java.io.File(fs.makeQualified(jpath).toUri().getPath()).createNewFile())
    try:
        fs.create(jpath, False).close()
        return True
    except Exception:
        if fs.exists(jpath):
            return False
        raise


def list_folder(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of the entries of ``path``; none if it is absent."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return []
    return [(s.getPath().getName(), int(s.getModificationTime())) for s in fs.listStatus(jpath)]


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath))


def delete_path(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Set the session's shuffle partitions from the size of the inputs."""
    n = shuffle_partitions_for(sum(path_size(spark, p) for p in paths),
                               minimum=spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", n)
    return n


__all__ = ["build_session", "checkpoint_root", "scratch_path", "shuffle_partitions_for",
           "size_shuffles", "path_size", "path_exists", "compile_wide_rows", "list_folder", "delete_path", "put_if_absent", "DEFAULT_CONF"]
