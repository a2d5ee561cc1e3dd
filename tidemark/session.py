"""Session construction and the shared folder that every executor can reach."""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_scratch: dict[str, str] = {}

#: Of written tables and intermediates: md5 text takes half the bytes that it has under the default codec.
COMPRESSION = "zstd"

# A listed file as text: "...FileStatus{path=...; isDirectory=...; length=...; modification_time=...; ...}".
_STATUS = re.compile(r"FileStatus\{path=(.*?); isDirectory=false;(.*?)\}", re.S)
_SIZE_AND_TIME = re.compile(r"\b(?:length|modification_time)=\d+")


def build_session(
    app_name: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """A session with the settings the jobs are tuned for. None of them is needed for right results:
    the operators also run on a session handed in from outside."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Split a hot join key even where that costs one more exchange further up.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


# Bytes a reduce task should get, and how far parquet unfolds.
_TASK_BYTES = 128 * 1024 * 1024
_EXPANSION = 3
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_set_here: dict[str, str] = {}
# Stored bytes a task reads at most: the latest row per key is sorted out before the exchange, of which 48 MB take 940 MB of memory.
_SPLIT, _SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", "32m"
# Compressed bytes that merged shuffle partitions hold: a task that joins and groups 64 MB of them has taken 790 MB of memory.
_MERGED, _MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "32m"
# Shuffle files otherwise stay until the driver's garbage collector comes by: those of all jobs of a build at once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def partitions_for(stored: int) -> int:
    """Shuffle partitions for so many bytes of parquet."""
    return max(1, -(-stored * _EXPANSION // _TASK_BYTES))


def fit_to_input(spark: SparkSession, folder: str) -> None:
    """Size shuffles for the largest table in ``folder``, on a session handed in from outside.

    Shuffles open as many partitions as that table calls for, never fewer than the session's setting, and
    adaptive execution merges small ones back. A skewed join is split even where the plan above it then
    needs one more exchange, and tasks read no more than they can sort in memory. Shuffle files go when the action that
    wrote them ends; an action repeated on the same frame writes them again. A setting the caller made
    is left alone; one made here for an earlier folder is made anew.
    """
    conf, app_id = spark.conf, spark.sparkContext.applicationId
    now = conf.get(_INITIAL, None)
    if now is None or now == _set_here.get(app_id):
        wanted = max([0, *(partitions_for(size) for size in table_bytes(spark, folder))])
        if wanted > int(conf.get("spark.sql.shuffle.partitions")):
            conf.set(_INITIAL, str(wanted))
            _set_here[app_id] = str(wanted)
        elif now is not None:
            conf.unset(_INITIAL)
    forced = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    if conf.get(forced) != "true":
        conf.set(forced, "true")
    for setting, value in ((_SPLIT, _SPLIT_BYTES), (_MERGED, _MERGED_BYTES), (_CLEANUP, "true")):
        if conf.get(setting, None) is None:
            conf.set(setting, value)


# Spark describes a plan anew whenever one of its stages ends, and keeps a description of each of the last thousand plans.
_DESCRIBED, _DESCRIBED_CHARS = "spark.sql.maxPlanStringLength", "4000"


@contextmanager
def light_driver(spark: SparkSession) -> Iterator[Callable[[], None]]:
    """For some hundred jobs in a row, on a driver of little memory. Plans are described in short meanwhile, unless the caller
    has set a length. What is yielded lets go of the broadcasts and plans of jobs that have ended: Spark drops them when the
    driver's garbage collector finds that nothing refers to them, which otherwise comes by once the heap has grown."""
    conf = spark.conf
    before = conf.get(_DESCRIBED, None)
    if before is None:
        conf.set(_DESCRIBED, _DESCRIBED_CHARS)
    try:
        yield spark._jvm.java.lang.System.gc
    finally:
        if before is None:
            conf.unset(_DESCRIBED)


def stored_bytes(spark: SparkSession, path: str) -> int:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(location).getLength()


def table_bytes(spark: SparkSession, folder: str) -> list[int]:
    """Stored bytes of each table in a folder of tables."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return [fs.getContentSummary(entry.getPath()).getLength() for entry in fs.listStatus(location)]


def input_state(spark: SparkSession, folder: str) -> str:
    """Changes whenever a file under a folder of tables is added, removed or rewritten: a hash of all paths, sizes and
    times, from one listing that comes over from the JVM in one piece."""
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = location.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(location, True)
    listed = spark._jvm.org.apache.hadoop.util.functional.RemoteIterators.toList(found).toString()
    files = sorted((path, *_SIZE_AND_TIME.findall(rest)) for path, rest in _STATUS.findall(listed))
    return hashlib.md5(repr(files).encode()).hexdigest()


INPUT_PARTITIONS = "spark.tidemark.inputPartitions"


def dealt_out(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """``scan`` over as many partitions as the session's ``spark.tidemark.inputPartitions`` says; as it is read
    where that is unset. For small inputs in one row group, which are one task on any number of cores."""
    parts = spark.conf.get(INPUT_PARTITIONS, None)
    return scan.repartition(int(parts)) if parts else scan


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediates. The cluster names it in ``spark.checkpoint.dir``; where that is
    unset, a session on one machine (``local``) uses a temporary folder, and any other fails: executors
    would write to disks of their own, and reads would miss rows."""
    app_id = spark.sparkContext.applicationId
    if app_id not in _scratch:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = configured.rstrip("/") if configured else tempfile.mkdtemp(prefix="tidemark-")
        _scratch[app_id] = f"{base}/tidemark-{app_id}"
    return _scratch[app_id]
