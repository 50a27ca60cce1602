"""Session helpers shared by queries, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def local_session(cpus: int = 8, **conf: str) -> SparkSession:
    """A local session with the defaults the library is tuned for."""
    options = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("LEXWEAVE_DRIVER_MEMORY", "8g"),
    } | conf
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=options).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return make_importable(spark)


def scratch(spark: SparkSession) -> str:
    """A new folder name under spark.checkpoint.dir, which all executors share; under a temporary folder only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lexweave-")
    path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}"
    _named.append(path)
    return path


_named: list[str] = []


def staged(df: DataFrame) -> DataFrame:
    """Write df to a folder of its own that all executors share and read it back: its lineage and its plan end there."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Delete what queries of this process have left under scratch(), once their results are no longer read; how many folders went."""
    gone = 0
    while _named:
        at = spark._jvm.org.apache.hadoop.fs.Path(_named.pop())
        gone += at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return gone


def make_importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when they see the same path.

    On a cluster without a shared checkout, ship it with ``--py-files``.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])
    return spark
