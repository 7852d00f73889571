"""Session helpers: shared scratch space, shipping of the package, table access."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_written: dict[int, tuple] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; the path may be of any file system that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of a batch that goes to a Python worker, where the session sets none: both sides hold a batch or two, and rows of text are large.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each application, and bound the bytes of a batch."""
    sc = spark.sparkContext
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(), "quizloom_pkg.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("quizloom", os.path.relpath(p, root)))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Where it is unset, one of our own, on a local master only."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        known = sc._jsc.sc().getCheckpointDir()
        if known.isEmpty():
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="quizloom-ckpt-"))
            known = sc._jsc.sc().getCheckpointDir()
        path = known.get()
    return path.rstrip("/")


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back, which ends its lineage.

    The files survive the loss of any executor. They are deleted by drop(), or when the application ends.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/quizloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(hpath)
    out = spark.read.schema(df.schema).parquet(path)
    _written[id(out)] = (weakref.ref(out, lambda _, k=id(out): _written.pop(k, None)), path)
    return out


def drop(*frames: DataFrame) -> None:
    """Delete the files of frames that cut() gave, once nothing reads them any more (a round's, when the next is written)."""
    for df in frames:
        if known := _written.pop(id(df), None):
            spark = df.sparkSession
            hpath = spark._jvm.org.apache.hadoop.fs.Path(known[1])
            hpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hpath, True)
