"""Session settings the library relies on, and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrameWriter, SparkSession

# Settings that change results, not just speed: calendar parts are UTC,
# and bad input (unparsable timestamps, non-integer durations) must fail
# the batch instead of turning into nulls.
CORRECTNESS_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings for scale: runtime re-planning, skew splitting, partition
# coalescing.  Safe to override per cluster.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# What one task reads.  Plays are often as many as their cells, so that a map-side combine
# holds a whole split: with splits and row groups of this size (about 800,000 plays) it
# stays in memory however large the tables are.
SPLIT_BYTES = 16 << 20
_SPLITS = "spark.sql.files.maxPartitionBytes"
_SPARKS_SPLITS = "134217728b"


def cluster_conf(total_cores: int, shuffle_bytes_per_task: str = "256m") -> dict[str, str]:
    """Settings for a large cluster (the command line applies them).

    Start with plenty of shuffle partitions (3 waves of the cluster's cores)
    and let AQE coalesce them to ``shuffle_bytes_per_task``; read input in
    splits of ``SPLIT_BYTES``.  Both bound the bytes one task holds, so sorts and
    aggregations spill rarely, and a skewed partition is split at runtime.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, 3 * total_cores)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": shuffle_bytes_per_task,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
        _SPLITS: str(SPLIT_BYTES),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "cadence", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured for this library."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**CORRECTNESS_CONF, **SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the result-changing settings to a session we did not build.

    They stay set: time zone and ANSI mode of the caller's session are UTC and
    on from then on, also for its own queries.  Input splits are bounded where the
    caller left Spark's default.
    """
    for k, v in CORRECTNESS_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    if spark.conf.get(_SPLITS) == _SPARKS_SPLITS:
        spark.conf.set(_SPLITS, str(SPLIT_BYTES))
    return spark


def small_groups(writer: DataFrameWriter) -> DataFrameWriter:
    """Parquet in row groups of a split each: a split can't be smaller than a row group."""
    return writer.option("parquet.block.size", SPLIT_BYTES)


def apply_cluster_conf(spark: SparkSession) -> SparkSession:
    """Apply the sizing for this cluster's cores where the user set nothing."""
    given = spark.sparkContext.getConf()
    for k, v in {**SCALE_CONF, **cluster_conf(spark.sparkContext.defaultParallelism)}.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or an already-set checkpoint dir).
    Only when neither is set and the master is local (one machine, as in
    tests) a fresh folder is created and registered.  On a cluster executors
    would each write to a disk of their own, so there it is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(root)
        return root.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="cadence-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df, label: str, small: bool = False):
    """Write ``df`` to a fresh folder under the shared checkpoint root and
    read it back: cuts the lineage (a lost executor re-reads files instead
    of recomputing upstream shuffles) in one job, stored as columnar
    parquet rather than serialized rows.  ``small``: in ``small_groups``."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    (small_groups(df.write) if small else df.write).parquet(path)
    return spark.read.parquet(path), path


def delete_path(spark, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
