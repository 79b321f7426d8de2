"""Where operators keep tables between their steps: the folder that the cluster shares.

All that a session keeps lies below one folder of its own there, which goes when the driver's process ends; tables that
only later steps of one operator read go as soon as these are written.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_RUNS: dict[str, str] = {}


def _remove(jvm, settings, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(settings).delete(path, True)
    except Exception:  # noqa: BLE001  the JVM may be gone, or the store may refuse; what stays is for whoever owns the folder
        return


def shared_folder(spark: SparkSession) -> str:
    """This session's own folder in ``spark.checkpoint.dir``; only where the session has none (a local test), in a folder of this machine. The setting is only read."""
    context = spark.sparkContext
    if context.applicationId not in _RUNS:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir isn't set; on a cluster it must name a folder that all executors share")
            folder = "file://" + tempfile.mkdtemp(prefix="titrant-")
        _RUNS[context.applicationId] = f"{folder.rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(_remove, context._jvm, context._jsc.hadoopConfiguration(), _RUNS[context.applicationId])
    return _RUNS[context.applicationId]


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: lineage is cut, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.settled_at = path
    return out


def released(*tables: DataFrame) -> None:
    """Settled tables that nothing will read any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        _remove(context._jvm, context._jsc.hadoopConfiguration(), df.settled_at)


#: So many bytes of input make a partition.
PARTITION_BYTES = 128 << 20


def partitions_for(df: DataFrame) -> int:
    """How many partitions a shuffle of ``df`` needs: ``spark.sql.shuffle.partitions``, or more where the tables it is read from are larger than that."""
    least = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    known = sum(x for x in sizes if x < 1 << 60)  # tables of unknown size say that they are as large as can be
    return max(least, -(-known // PARTITION_BYTES))
