"""Session helpers: a local session for tests and benchmarks, scale settings,
and the shared scratch location (``spark.checkpoint.dir``)."""

from __future__ import annotations

import hashlib
import io
import math
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at cluster scale; applied only where the session leaves them unset.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # rows that a Python worker holds at once; whole texts make wide rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2500",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "valuepay") -> SparkSession:
    """A local[N] session as used by the tests and ``bench.py``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("VALUEPAY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SCALE_DEFAULTS, "spark.sql.session.timeZone": "UTC"}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_scale_defaults(spark: SparkSession) -> None:
    """Turn on AQE (coalescing, skew-join splitting) unless the cluster configured otherwise."""
    for k, v in SCALE_DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none (local tests) is a local folder created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="valuepay-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder, in this application's own folder: frames that
    were made from scratch tables read them, so the folder may be deleted when the application has ended."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/valuepay-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: later readers scan files, with
    column pruning and pushed filters, and a lost executor costs nothing that was written."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started: an archive of its
    modules goes to the executors, once per application. The archive's name holds its content's
    hash, and Spark copies it from the driver, so no shared folder is needed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".py"))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for f in files:
            with open(f, "rb") as source:
                archive.writestr(zipfile.ZipInfo(os.path.relpath(f, os.path.dirname(root))), source.read())
    data = buffer.getvalue()
    path = os.path.join(tempfile.mkdtemp(prefix="valuepay-package-"), f"valuepay-{hashlib.sha256(data).hexdigest()[:16]}.zip")
    with open(path, "wb") as out:
        out.write(data)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def planned_bytes(frames: Iterable[DataFrame]) -> int:
    """Catalyst's size estimate of the given frames (file sizes for scans; no job runs)."""
    total = 0
    for df in frames:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        total += size if isinstance(size, int) else int(size.toString())
    return total


def shuffle_partitions_for(input_bytes: int, current: int, target_bytes: int = 256 << 20,
                           cap: int = 50_000) -> int:
    """Initial shuffle partitions so that each covers about ``target_bytes`` of input (the
    shuffled data is smaller after column pruning and partial aggregation); never fewer than
    the session already uses, at most ``cap`` to bound the number of shuffle blocks. AQE
    coalesces the small ones afterwards."""
    return max(current, min(cap, math.ceil(input_bytes / target_bytes)))


MAX_PARTITION_BYTES = "spark.sql.files.maxPartitionBytes"


def scan_split_bytes(spark: SparkSession) -> int:
    """The session's largest scan split."""
    return _bytes(spark.conf.get(MAX_PARTITION_BYTES))


def split_bytes_for(input_bytes: int, current: int, max_tasks: int = 200_000,
                    cap: int = 1 << 30) -> int:
    """Scan split size keeping one scan under about ``max_tasks`` tasks; never below the
    session's own value, never above ``cap`` (an unknown size estimate is huge)."""
    return max(current, min(cap, -(-input_bytes // max_tasks)))


SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
TASK_BYTES = 16 << 20      # of compressed input for a task that sorts or joins: a few hundred MB as rows
UNKNOWN_BYTES = 1 << 60    # Catalyst's sizes from here on say that it does not know


def input_bytes(frames: Iterable[DataFrame]) -> int:
    """The size of the tables that the given frames scan, each scan counted (no job runs). Unlike ``planned_bytes`` it
    does not multiply the sides of a join; a table of unknown size counts as none."""
    total = 0
    for df in frames:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        total += sum(s for s in sizes if s < UNKNOWN_BYTES)
    return total


@contextmanager
def bounded_tasks(spark: SparkSession, frames: Iterable[DataFrame]):
    """Keep what one task sorts, joins or aggregates to the same size whatever the input's, for the duration of jobs that
    read ``frames``: scan splits and shuffle partitions grow in number, not in size, so nothing spills that did not
    at a smaller input. The session's values are only made finer, and restored afterwards."""
    size = input_bytes(frames)
    wanted = {
        SHUFFLE_PARTITIONS: shuffle_partitions_for(size, int(spark.conf.get(SHUFFLE_PARTITIONS)), TASK_BYTES // 2),
        ADVISORY_BYTES: min(_bytes(spark.conf.get(ADVISORY_BYTES)), 2 * TASK_BYTES),   # shuffled rows are larger than stored ones
        MAX_PARTITION_BYTES: min(scan_split_bytes(spark), split_bytes_for(size, TASK_BYTES)),
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, str(value))
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def sized_shuffle(spark: SparkSession, frames: Iterable[DataFrame]):
    """Size a job to its input for its duration: AQE's initial shuffle partition number
    (AQE can merge partitions but never split a plain aggregation's, so the start value must
    be large enough for the data) and the scan split size (so a 100 TB scan is not a million
    tasks). A setting the user made explicitly is left alone; both are restored afterwards."""
    frames = list(frames)
    size = planned_bytes(frames)
    changed: list[str] = []
    n = None
    if spark.conf.get(INITIAL_PARTITIONS, None) is None:
        n = shuffle_partitions_for(size, int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.conf.set(INITIAL_PARTITIONS, str(n))
        changed.append(INITIAL_PARTITIONS)
    if spark.conf.get(MAX_PARTITION_BYTES, None) is None:
        default = _bytes(spark.conf.get(MAX_PARTITION_BYTES))
        split = split_bytes_for(size, default)
        if split > default:
            spark.conf.set(MAX_PARTITION_BYTES, str(split))
            changed.append(MAX_PARTITION_BYTES)
    try:
        yield n
    finally:
        for key in changed:
            spark.conf.unset(key)


def _bytes(text: str) -> int:
    """Parse a Spark byte size such as ``134217728b``, ``128m`` or ``1g``."""
    t = text.strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if t and t[-1] in units:
        return int(float(t[:-1]) * units[t[-1]])
    return int(t)
