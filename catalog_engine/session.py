"""Session helpers: building a local session for tests/bench, and the
shared checkpoint folder rule (read ``spark.checkpoint.dir`` from the
session; only set our own when it is unset, as in tests)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a catalogue side that may be broadcast to every executor. The
# check is done on a counted, de-duplicated catalogue (see
# ``operators.matching.plan_candidates``); beyond it the match join uses a
# shuffled plan instead.
DEFAULT_BROADCAST_ROWS = 2_000_000
# ... and only while its estimated in-memory size stays under this bound.
DEFAULT_BROADCAST_BYTES = 512 * 1024 * 1024


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "catalog_engine") -> SparkSession:
    """Session used by tests and bench.py (no UI, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is; when it is unset there, this raises, as no machine's own folder
    would do. Only a local master gets a folder under the system temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:                      # already set (cluster or earlier call)
        return current
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base and (not sc.master.startswith("local") or sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = base or tempfile.mkdtemp(prefix="catalog-engine-ckpt-")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir() or base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for a written intermediate table below the shared
    checkpoint folder (never a machine-local temp folder on a cluster)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its Hadoop file system. Storage errors are
    raised, so that a failure is never taken for "not there"."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written_once(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table below the shared checkpoint folder: what they come
    from runs once. Unlike the parts of a checkpoint, its small files are read together."""
    path = scratch_path(df.sparkSession, f"rows-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (Parquet); Catalyst prunes columns and pushes
    filters into this scan."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _spread_already(plan, target: int) -> bool:
    """Whether rows were dealt out to as many tasks just before."""
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.child()
    return plan.nodeName() in ("Repartition", "RepartitionByExpression") and plan.numPartitions() >= target


def spread_for_compute(df: DataFrame, partitions: int = 0) -> DataFrame:
    """Repartition to the session's parallelism (``partitions`` if that is more) before CPU-heavy
    per-row work (HTML extraction, pair scoring). Whether the input needs it
    is read from the size of the tables below it, without running any of its stages; inputs
    that are already well split (many files at scale, or spread before) are left as they are.

    Rows are dealt by their hash: dealing them in turn would sort each task's
    rows first, in memory that grows with long texts. Exact copies stay together."""
    target = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_task = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if _spread_already(plan, target) or (not partitions and size >= target * per_task):
        return df
    by = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return df.repartition(max(target, partitions), *by)
