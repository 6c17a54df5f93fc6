"""Session factory and session-level settings.

The library pins the session time zone to UTC (dates, hours and week starts
of transactions are defined in UTC) and relies on adaptive query execution
for partition coalescing, skew-join splitting and runtime broadcast choice.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library needs on any session it runs in. They are runtime SQL
# confs, so they can be applied to a caller's session too.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # HotSpot never compiles a larger method, and interprets it row by row
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings recommended for cluster runs; applied only where the caller left
# them unset.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "ledgerlens",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in {**RECOMMENDED_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerlens.operators.prepare import q

    q.cache_clear()  # cached column references belong to the previous JVM
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, under the shared checkpoint
    folder the cluster names in ``spark.checkpoint.dir`` (its scheme kept).

    Where that setting is unset, a local session gets a folder of its own,
    registered as the checkpoint dir so that later calls share it. On a
    cluster the setting is required: a machine-local folder would give each
    executor a disk of its own and later reads would miss files.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                f"spark.checkpoint.dir is unset and the master is {sc.master}: "
                "name a folder that the driver and all executors share"
            )
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-ckpt-"))
        base = sc.getCheckpointDir()
    own = f"{base.rstrip('/')}/ledgerlens/{sc.applicationId}"
    if own not in _scratch:
        _scratch.add(own)
        atexit.register(_drop_at_exit, spark, own)
    return f"{own}/{name}-{uuid.uuid4().hex}"


_scratch: set[str] = set()


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    try:
        drop_path(spark, path)
    except Exception:  # noqa: BLE001 - the session has ended; the folder is named by application
        pass


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application. Results that read
    them must have been used before. Runs by itself when Python ends."""
    for path in [p for p in _scratch if p.endswith("/" + spark.sparkContext.applicationId)]:
        drop_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, asked of Spark's own file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table through Spark's own file system layer."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
