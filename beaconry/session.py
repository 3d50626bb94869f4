"""Session settings, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Collection
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on; all may be overridden afterwards.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot product or neighbour may hold a third of a join side: let AQE split it
    # even where the split costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sessions of a hot user are merged inside each map task before the shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    # Spark copies the archive to its own file store at once and serves it from there.
    name = Path(tempfile.mkdtemp(prefix="beaconry-zip-")) / package.name
    sc.addPyFile(shutil.make_archive(str(name), "zip", package.parent, package.name))
    _SHIPPED.add(sc.applicationId)


def tune(spark: SparkSession, keep: Collection[str] = ()) -> SparkSession:
    """Ready a session for the operators: the package on the executors and the runtime settings, but for ``keep``."""
    ship_package(spark)
    for key, value in RUNTIME_CONF.items():
        if key not in keep:
            spark.conf.set(key, value)
    if not spark.sparkContext.master.startswith("local"):
        # Start with more shuffle partitions than cores; adaptive execution merges small ones.
        cores = spark.sparkContext.defaultParallelism
        first = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * cores)
        if spark.conf.get(INITIAL_PARTITIONS, None) is None:
            spark.conf.set(INITIAL_PARTITIONS, str(first))
    return spark


def get_session(app: str = "beaconry", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.maxMetadataStringLength", "1000")  # plans name long folders in full
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate(), conf)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine; on a cluster the
    setting is required, since a lost executor must find the files again.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="beaconry-")
    sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and continue from its reliable checkpoint."""
    spark = df.sparkSession
    root = scratch_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)
