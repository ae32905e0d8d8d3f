"""Table access and lineage cutting shared by all operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    spark.checkpoint.dir names it on a cluster. Only a local master may fall back to a
    temporary folder, because there driver and executors are one process.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="wayfold-ckpt-")
    sc.setCheckpointDir(named)
    return named


_written: dict[str, SparkSession] = {}


def _delete(path: str) -> None:
    spark = _written.pop(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _clean() -> None:
    """Remove the tables of a session that is still there when Python ends."""
    for path in list(_written):
        try:
            _delete(path)
        except Exception:  # the session ended first; the folder is the cluster's to clear
            return


def release(*tables: DataFrame) -> None:
    """Delete tables that materialize wrote and that no later step reads: the state of a round once the next is written."""
    for df in tables:
        path = getattr(df, "_wayfold_path", None)
        if path in _written:
            _delete(path)


atexit.register(_clean)


def materialize(df: DataFrame) -> DataFrame:
    """Write df as a table in the shared checkpoint folder and go on from there.

    Survives lost executors and cuts the lineage. A written table is preferred to checkpoint(),
    whose result keeps the size estimate of the plan behind it: in loops that join a state with
    itself that estimate squares every round, while a table has the size of its files, by which the
    planner may also broadcast safely.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._wayfold_path = path
    return out


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are worked out once, where they stand.

    A filter or projection over a plain column takes the column's expression with it, down to the
    join below and once a use; loops of so much code are never compiled. It does not pass explode.
    """
    for name, value in columns.items():
        df = df.withColumn(name, F.explode(F.array(value)))
    return df


def salts_for(rows: int, per_task: int = 200_000) -> int:
    """How many parts a key of so many rows is split into, so that no task holds more than per_task."""
    return max(1, -(-rows // per_task))
