"""Session helpers: conservative defaults and lineage-cutting storage locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume.  Only applied when a session is *built* here; a
# session handed in by a caller keeps its own configuration, so every operator
# also avoids depending on these (timestamps are built as TIMESTAMP_NTZ
# explicitly, for example).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "snapledger",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    On a cluster this must be the shared location the cluster names in
    ``spark.checkpoint.dir``; we only invent a local folder when the setting is
    absent (local tests).
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: intermediate tables must "
                               "survive the loss of an executor")
        root = tempfile.mkdtemp(prefix="snapledger-ckpt-")      # local mode only (tests)
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def cut_lineage(df: DataFrame, name: str = "table") -> DataFrame:
    """Materialise ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage (iterative merges, audits that scan a table many times) like
    ``checkpoint()``, but the result stays columnar, so later scans keep column
    pruning and predicate pushdown.  The folder is the cluster's shared
    ``spark.checkpoint.dir``: a lost executor's work is recomputed, never lost.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)


def deal(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over ``spark.sql.shuffle.partitions`` tasks, at every size.

    For CPU-heavy per-row work (geometry, regex) on narrow rows, whose cost outweighs the shuffle and
    follows neither the file layout nor the row-group size.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder nobody else uses: drivers may share the checkpoint folder and even their process ids."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/snapledger/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
