"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def use_utc(spark: SparkSession) -> SparkSession:
    """Time text and window bounds in this package are in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(spark: SparkSession, watermark_policy: str = "min") -> SparkSession:
    """A sibling session with the settings keyed state needs; the caller's
    session keeps its own. ``watermark_policy`` says which of several inputs'
    watermarks counts."""
    sibling = use_utc(spark.newSession())
    for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        sibling.conf.set(key, spark.conf.get(key))
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    sibling.conf.set("spark.sql.streaming.multipleWatermarkPolicy", watermark_policy)
    return sibling


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    It must be one that every executor can reach. Only a local master, as in
    tests, falls back to a temporary folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidematch-")
        context.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared root, for tables and stream state."""
    return f"{checkpoint_root(spark)}/tidematch/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application.

    Python operators refer to the package by name, and executors need not have
    it on their path.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tidematch-code-")) / "tidematch-package.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for path in sorted(package.rglob("*.py")):
            target.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
