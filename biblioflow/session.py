"""Session helpers: table access, shipping the package to executors, lineage cuts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers.

    Nothing is sent when PYTHONPATH already names the repository or when workers
    start in it; otherwise a zip of the package goes through Spark's file server.
    """
    seen = [Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    sc = spark.sparkContext
    if ROOT in seen or getattr(sc, "_biblioflow_shipped", False):
        return
    stem = os.path.join(tempfile.mkdtemp(prefix="biblioflow-"), "biblioflow")
    sc.addPyFile(shutil.make_archive(stem, "zip", ROOT, "biblioflow"))
    sc._biblioflow_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One parquet table; only the named columns reach the scan."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan has fewer splits than cores (one small file, say).

    Larger inputs have more splits than that and are left as they are, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors share.

    It is the one that ``spark.checkpoint.dir`` names. Where that is unset a local
    session (tests) takes a directory below its warehouse; a cluster is refused.
    """
    sc = spark.sparkContext
    there = sc._jsc.sc().getCheckpointDir()
    if there.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
        there = sc._jsc.sc().getCheckpointDir()
    return there.get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage by a table written to the shared folder; a lost executor repeats nothing before it.

    Parquet takes a fraction of the room of checkpointed rows and its columns are
    read one by one. `release` deletes the table when nothing reads it any more.
    """
    if any(f.dataType.typeName() == "void" for f in df.schema.fields):
        shared_folder(df.sparkSession)
        return df.checkpoint(eager=True)
    there = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(there)
    out = df.sparkSession.read.schema(df.schema).parquet(there)
    out._stored_at = there
    return out


def release(df: DataFrame | None) -> None:
    """Delete what `checkpoint` wrote for this very DataFrame; others are left alone."""
    there = getattr(df, "_stored_at", None)
    if there:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(there)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
