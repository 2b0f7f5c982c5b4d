"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and UTC times; ``conf`` overrides any of it."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the checkpoint folder the session names; only a local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="crossfoot-checkpoint-")
    context.setCheckpointDir(folder)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared checkpoint folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Used where several branches of one plan must see the very same rows, or where a costly input would otherwise be
    computed once per branch. The copy outlives lost executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ref(name: str) -> Column:
    """Column reference that survives spaces, dots, ampersands and backticks in ``name``."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    """Column name for SQL text. Wide tables build their expressions as text: one call instead of one per column."""
    return "`" + name.replace("`", "``") + "`"


def literal(value: str) -> str:
    """String literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def inline_cells(cells: list[dict[str, str]]) -> Column:
    """Generator that turns one row into one row per cell; each cell maps output names to SQL text."""
    structs = [f"struct({', '.join(f'{text} AS {quoted(name)}' for name, text in cell.items())})" for cell in cells]
    return F.expr(f"inline(array({', '.join(structs)}))")
