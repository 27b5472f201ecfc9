"""Session helpers: building a session for tests/bench, and finding the shared
folder the cluster names for checkpoints and intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ARROW_BYTES_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch on its way to a Python task; a longer row is a batch of its own.
BATCH_BYTES = 1 << 20


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "citystream") -> SparkSession:
    """Session for tests and the benchmark. On a cluster the session comes from
    spark-submit and only `configure` is applied."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    spark = (builder
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.execution.arrow.pyspark.enabled", "true")
             .config("spark.driver.memory", os.environ.get("CITYSTREAM_DRIVER_MEMORY", "16g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings every query relies on: UTC wall clock (event times are epoch
    based) and AQE for runtime re-planning of joins and partition counts."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Python workers on this machine find the package wherever the session was
    # started; a cluster gets it with --py-files
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return spark


def bounded_batches(spark: SparkSession) -> None:
    """From now on Python tasks of this session get Arrow batches of about BATCH_BYTES, unless the session
    sets another bound. A task and its JVM hold several batches, which are 10 000 rows of any length otherwise."""
    if ARROW_BYTES_CONF not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES_CONF, str(BATCH_BYTES))


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream sinks and materialised tables.

    Read from `spark.checkpoint.dir`. Only a local session may leave it unset
    (as in ad-hoc tests); on a cluster a folder of one machine would lose data."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError(f"{CHECKPOINT_CONF} is unset: name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="citystream-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared root."""
    return f"{shared_root(spark)}/citystream/{name}-{uuid.uuid4().hex[:12]}"
