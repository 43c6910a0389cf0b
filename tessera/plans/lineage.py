"""Cut lineage by writing a table to the folder that driver and executors share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def work_dir(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir``, or, on one machine only (tests), a temporary one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{work_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below :func:`work_dir` and read it again.

    Lost executors then cost a re-read only, and later joins know the table's size.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tessera_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what :func:`cut` wrote for ``tables``, once nothing reads them any more, and the shuffle files of plans that are gone."""
    for t in tables:
        remove(t.sparkSession, t._tessera_path)
    if tables:
        collect(tables[0].sparkSession)


def collect(spark: SparkSession) -> None:
    """Collect the driver's heap: Spark then deletes the shuffle files of plans that are gone."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for spark, path in _written:
        try:
            remove(spark, path)
        except Exception:  # the session has ended: the cluster's own clean-up has the folder
            return
