"""Intermediate tables in the shared folder of the session."""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

from crossfoot.runtime import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a session without one gets that of its checkpoints."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        ensure_checkpoint_dir(spark)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as compressed Parquet below the shared folder and read it back.

    For tables as large as the input, where ``checkpoint()`` would write uncompressed rows. Readers of the result prune
    columns, and a lost executor costs only a file read.
    """
    path = f"{shared_folder(df.sparkSession)}/crossfoot-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _delete(df.sparkSession, path, at_exit=True)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


_PATHS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stored`` that nothing will read again. The others go when the application ends."""
    for table in tables:
        _delete(table.sparkSession, _PATHS.pop(table))


def _delete(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    if at_exit:
        system.deleteOnExit(place)
    else:
        system.delete(place, True)
