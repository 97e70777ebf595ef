"""What every operator needs from the cluster: shipped code and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: By application, the folder that is made on a single machine.
_FOLDERS: dict[str, str] = {}
#: Rows go to Python workers in batches of 10,000, whatever their size, if nothing else is
#: said; of long texts that is more than a worker should hold.
_BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application, and bound the bytes of
    the batches that workers get, where the session doesn't.

    Python workers import the operators by name, so the package has to be there even
    where it isn't installed on the machines.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_BYTES[0], None) is None:
        spark.conf.set(*_BATCH_BYTES)
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{name}-src.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: the session's spark.checkpoint.dir.

    Only on one machine, as in tests, a temporary folder is made where that is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        sc = spark.sparkContext
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all machines share")
        if sc.applicationId not in _FOLDERS:
            _FOLDERS[sc.applicationId] = tempfile.mkdtemp(prefix="shared-")
        folder = _FOLDERS[sc.applicationId]
    return folder.rstrip("/")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is; a missing one is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder that all machines share and read it from there."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read from there; `forget` deletes it.

    Smaller than a checkpoint and gone when told, but its rows come in other partitions.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def forget(*kept: DataFrame) -> None:
    """Delete what `keep` wrote, and have the driver let go of shuffles that nothing needs."""
    for df in kept:
        delete_folder(df.sparkSession, df.kept_at)
    if kept:
        let_go(kept[0].sparkSession)


def let_go(spark: SparkSession) -> None:
    """Have the driver delete the shuffles of queries that nothing refers to any more."""
    spark._jvm.System.gc()
