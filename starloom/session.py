"""Session settings the library relies on.

ANSI mode stays on (every cast/parse on dirty text uses a ``try_`` form),
AQE re-plans joins from measured sizes (so broadcast decisions rest on real
shuffle statistics, not guesses) and splits skewed join partitions.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# Settings that change results or plan shape; applied to an existing session
# too (they are all runtime SQL confs).
RUNTIME_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Stamps are parsed and rendered in one zone, strictly.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "EXCEPTION",
    # Top-1 dedup keeps its partial (map-side) group limit.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000",
    # A generated method beyond 8000 bytes of bytecode is never compiled by the JVM and runs interpreted, many times
    # slower: the wide cleansing projections are then generated as many small methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Text derived from a few bytes of Parquet, or read back from a well packed shuffle, is many times as long in
    # memory: small splits and partitions keep a task's sorts and tables out of its spill files.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Joins with a small key side per partition hash that side and leave the wide one unsorted.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    # Rows alone (10,000) don't bound an Arrow batch on its way to a Python worker, and both sides hold it.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def get_session(app_name: str = "starloom", master: str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session (configured) or build a local one.

    On a cluster the launcher owns master, memory and the checkpoint folder;
    this only fills what is unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        spark = active
    else:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        builder = (builder
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false")
                   .config("spark.sql.session.timeZone", "UTC"))
        spark = builder.getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir``; only when it is unset and the master is
    local (tests) a fresh scratch folder is created and registered.  On a
    cluster a folder of the driver's machine would be of no use, so there an
    unset one is an error.
    """
    conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="starloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


_ROOTS: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """This application's folder under the shared checkpoint folder.  It goes
    when the driver's Python ends: results are lazy, so what they read has to
    stay as long as the session may be used."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = f"{checkpoint_dir(spark).rstrip('/')}/starloom-{app}"
        path = sc._jvm.org.apache.hadoop.fs.Path(_ROOTS[app])
        atexit.register(_remove, path.getFileSystem(sc._jsc.hadoopConfiguration()), path)
    return _ROOTS[app]


def _remove(file_system, path) -> None:
    try:
        file_system.delete(path, True)
    except (Py4JError, OSError):  # the JVM is gone already; the cluster clears the folder
        pass


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``starloom`` importable in the Python workers of this application
    (needed where tasks run Python: the workbook source/sink and the
    JSON-array sink).  The package is zipped once and distributed with
    ``SparkContext.addPyFile``, the standard way to ship code to executors."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    staging = tempfile.mkdtemp(prefix="starloom-pkg-")
    zpath = os.path.join(staging, "starloom.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 256 << 20, minimum: int = 200) -> int:
    """Initial shuffle partition count so no post-shuffle partition has to
    hold more than ``target_bytes`` of the input (AQE coalesces down from it)."""
    return max(minimum, -(-int(input_bytes) // int(target_bytes)))


def tune_for_input(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Size scans and shuffles for an input volume (e.g. 100 TB -> ~400k
    initial shuffle partitions of <= 256 MB, coalesced by AQE at run time).
    Returns the initial partition count it set."""
    n = shuffle_partitions_for(input_bytes, target_bytes)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
