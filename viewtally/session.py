"""Session defaults for tests, the bench and local runs.

On a cluster the deployment owns these settings; nothing here overrides a
value that is already set, except where a test asks for it.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "viewtally") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder lineage cuts go to: the one the session has, else the one
    ``spark.checkpoint.dir`` names.  Where neither is set, local runs (tests)
    get a fresh scratch folder; a cluster must name a folder its executors
    share.  ``setCheckpointDir`` opens a new folder below the one it is given,
    so it is called once a session at most and the path never changes."""
    sc = spark.sparkContext
    now = sc.getCheckpointDir()
    if now:
        return now
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {sc.master}")
        d = tempfile.mkdtemp(prefix="viewtally-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def cluster_settings(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Settings for a cluster run sized from the input volume.

    * splits of 256 MB keep a scan task's JSON parse within a few seconds and
      its memory small; 100 TB gives ~400k scan tasks;
    * every shuffle here carries partially aggregated rows (tiers, per-tick
      partials), a small fraction of the input, so the shuffle starts wide
      (one partition per ~1 GB of input, at least 3 per core) and AQE
      coalesces it to ~128 MB partitions;
    * skewed shuffle partitions are split by AQE; hot keys are already
      absorbed by map-side partial aggregation;
    * explicit broadcasts here are size-checked by the code; the automatic
      threshold stays moderate so AQE may switch small joins at run time.
    """
    gb = 1 << 30
    shuffle = max(total_cores * 3, input_bytes // gb)
    return {
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
    }
