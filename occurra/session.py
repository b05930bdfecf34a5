"""SparkSession defaults the pipeline relies on.

Only settings with a semantic effect are forced (UTC session zone, ANSI casts);
everything else is a default a cluster configuration may override.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SEMANTIC_CONF = {
    # Dates derived from zoned timestamps are UTC calendar days.
    "spark.sql.session.timeZone": "UTC",
    # try_cast / try_to_date are used explicitly; bare casts must fail loudly.
    "spark.sql.ansi.enabled": "true",
}

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "occurra",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline's settings.

    ``master`` is left to spark-submit when ``None``.  ``spark.checkpoint.dir``
    must name a folder that the driver and all executors share.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **SEMANTIC_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shuffle_partitions_for(input_bytes: int, cores: int = 1, bytes_per_partition: int = 64 << 20) -> int:
    """``spark.sql.shuffle.partitions`` for so much compressed columnar input.

    About ``bytes_per_partition`` of input per shuffle partition, which decode
    to a few times that, and at least one partition per core; AQE merges what
    partial aggregation leaves small.
    """
    return max(-(-int(input_bytes) // int(bytes_per_partition)), int(cores), 1)


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder that ``spark.checkpoint.dir`` names."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) before running jobs that cut lineage"
        )
    spark.sparkContext.setCheckpointDir(configured)
    return configured
