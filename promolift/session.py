"""Session helpers.

On a cluster the session is supplied by the caller; these helpers only fill in
settings that are unset (tests, local runs).  ``checkpoint_dir`` reads
``spark.checkpoint.dir`` from the session and only sets a scratch folder when the
cluster did not name one.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "promolift", driver_memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", driver_memory))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir
    if not sc.master.startswith("local"):
        # a machine-local folder would not survive executor loss on a cluster
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    # Unset in a local session (tests, local runs): a scratch folder is fine there.
    local = tempfile.mkdtemp(prefix="promolift-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


#: Called with every DataFrame whose lineage is cut (tests look at the plans of all stages).
LISTENERS: list = []


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing a Parquet table into the shared checkpoint folder and
    reading it back: one job (``Dataset.checkpoint`` would compute the plan twice
    unless cached), the result survives executor loss, and later scans get column
    pruning and row-group statistics."""
    for listener in LISTENERS:
        listener(df)
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/promolift/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of ``frames``, by column name, joined in pairs: a chain of unions is analysed anew
    for each of them."""
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i] for i in range(0, len(frames), 2)]
    return frames[0]


_SHIPPING = threading.Lock()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once per session (``addPyFile``): functions
    that run in tasks refer to its modules.  Jobs ask for it from several threads, and Spark
    refuses a second file of that name."""
    sc = spark.sparkContext
    with _SHIPPING:
        if getattr(sc, "_package_shipped", False):
            return
        top = os.path.dirname(os.path.abspath(__file__))
        path = os.path.join(tempfile.mkdtemp(), "promolift_modules.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for n in names:
                    if n.endswith(".py"):
                        full = os.path.join(folder, n)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
        sc._package_shipped = True
