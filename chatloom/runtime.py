"""Session set-up and the shared folder used for checkpoints and operator state."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "chatloom", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own session."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    b = SparkSession.builder.master(f"local[{n}]").appName(app).config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", str(n))
    for k, v in {**_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; on a local master, where it may be unset, one of our own.

    A cluster without that setting is refused, since each executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    given = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        chosen = getattr(sc, "_chatloom_dir", None)
        if chosen is None:
            folder = tempfile.mkdtemp(prefix="chatloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            chosen = "file://" + folder
            sc._chatloom_dir = chosen
        given = chosen
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(given)
    return given.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for one table in the application's part of the shared folder."""
    return f"{shared_dir(spark)}/chatloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written there; results that read from it must be used up or saved before."""
    drop_path(spark, f"{shared_dir(spark)}/chatloom/{spark.sparkContext.applicationId}")


@contextmanager
def scratch_cleared(spark: SparkSession) -> Iterator[None]:
    """Around work whose results are saved inside: what it has written to the shared folder is deleted at the end."""
    try:
        yield
    finally:
        clear_scratch(spark)


def persisted(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
