"""Session helpers: a local session for tests/bench and the lineage-cut
helper that honours ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "titleflow") -> SparkSession:
    """A local[N] session with AQE on and the web UI off.

    On a cluster, build the session with the cluster's own settings; this
    helper is for tests and the bench only.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's shared folder always wins. Only a local-mode session with
    no setting at all gets a private temporary folder (tests); a cluster
    session without the setting is an error, because a machine-local folder
    does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before cutting lineage")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="titleflow-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder.

    Used where a DataFrame feeds many jobs (hyper-parameter search) so that
    a lost executor re-reads the checkpoint instead of replaying the whole
    upstream plan. Never ``localCheckpoint``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
