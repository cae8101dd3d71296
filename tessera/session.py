"""Session helpers.

``local_session`` is for tests, the bench and the tools only: on a cluster
the session comes from the caller, already configured, and operators never
change its settings. ``cut_lineage`` (reliable checkpoints in the session's
folder) and ``ship_package`` (code for Python workers) are used by the
operators that need them.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    """A local session sized for tests and the bench.

    AQE stays on (runtime coalescing, skew-join splitting); the web UI is off.
    """
    n = os.cpu_count() if cores == "*" else int(cores)
    parts = shuffle_partitions or n
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        # Throughput collector for the single local JVM (batch work, no
        # pause-time goals); about 10% faster than G1 on the bench here.
        .config("spark.driver.extraJavaOptions",
                os.environ.get("TESSERA_JAVA_OPTS", "-XX:+UseParallelGC"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder reliable checkpoints go to.

    A cluster names a shared folder in ``spark.checkpoint.dir``, which Spark
    applies to the context at start-up; that (or a folder already set on the
    context) is used as is. Only a local session with none (tests, the
    bench) gets a scratch folder of its own. A cluster session without one
    is an error, never a machine-local folder. (The setting itself cannot be
    changed at runtime, so the scratch folder goes to the context only.)
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (a reliable
    checkpoint: it survives lost executors, and later stages read it instead
    of recomputing the lineage). Never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession | None = None) -> None:
    """Make this package's functions usable in Python workers that cannot
    import it (a cluster where it is not installed, or a driver started
    outside the repository): functions and classes defined here are pickled
    by value, together with the UDFs that use them, instead of by module
    reference. No files are written or copied.

    The operators that run Python (Arrow UDFs, ``mapInPandas``) call this.
    """
    import tessera
    from pyspark import cloudpickle

    if "tessera" not in cloudpickle.list_registry_pickle_by_value():
        cloudpickle.register_pickle_by_value(tessera)
