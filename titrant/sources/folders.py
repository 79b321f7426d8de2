"""Tables kept between steps: in the folder that the session's cluster shares.

All that a session keeps lies below one folder of its own there, which goes when the driver's process ends.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNS: dict[str, str] = {}


def _removed(jvm, settings, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(settings).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM may be gone; what stays is for whoever owns the folder
        return


def shared(spark: SparkSession) -> str:
    """This session's own folder in ``spark.checkpoint.dir``; where a local session has none, in a temporary folder. The setting is only read."""
    context = spark.sparkContext
    if context.applicationId not in _RUNS:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="titrant-")
        _RUNS[context.applicationId] = f"{folder.rstrip('/')}/tables-{uuid.uuid4().hex}"
        atexit.register(_removed, context._jvm, context._jsc.hadoopConfiguration(), _RUNS[context.applicationId])
    return _RUNS[context.applicationId]


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back."""
    path = f"{shared(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def released(*tables: DataFrame) -> None:
    """Written tables that nothing will read any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        _removed(context._jvm, context._jsc.hadoopConfiguration(), df.written_at)
