"""Session helpers: a configured local session for tests/bench, and the shared
work folder used to cut lineage and hold sink output."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "rarecast") -> SparkSession:
    """Session for tests and the bench.  On a cluster the caller's session is
    used as-is; nothing here is required by the operators."""
    master = master or os.environ.get("RARECAST_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """All calendar logic (hour, weekday, MMddHHmm tags) is defined in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables: the cluster's
    ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Where neither is set, a
    local master gets a scratch folder; a cluster has to name one that all machines share."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="rarecast-work-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def compiled_methods(spark: SparkSession):
    """For writing frames of very many expressions: the JVM leaves a generated method above 8,000 bytes uncompiled, so
    stages above that run as separate projections, whose methods Spark keeps small."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
