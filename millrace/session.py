"""Session settings and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every operator relies on for right results. Sizing knobs (shuffle
# partitions, split sizes, broadcast limits) stay with the cluster's own config.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.fieldId.read.enabled": "true",
    "spark.sql.parquet.fieldId.write.enabled": "true",
}

_local_base: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on; safe to call repeatedly."""
    for key, value in SEMANTIC_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "millrace", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for written tables and stream checkpoints.

    The base is the shared folder named in ``spark.checkpoint.dir``. Only a
    local-mode session may fall back to a temporary folder of this machine.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="millrace-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def together(spark: SparkSession, tasks: Sequence[Callable], width: int = 16) -> list:
    """Run independent Spark actions at the same time, so that small tables do
    not leave the cluster idle. All finish before the first error is raised."""
    if len(tasks) < 2:
        return [t() for t in tasks]
    with ThreadPoolExecutor(min(width, len(tasks))) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
    return [f.result() for f in futures]
