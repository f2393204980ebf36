"""Tables written to the folder all executors share.

Intermediate results that several later jobs read (and that must not be recomputed
differently when an executor is lost) are written as parquet below the folder named by
``spark.checkpoint.dir``. Parquet rather than an RDD checkpoint: the rows are computed
once, and later jobs read only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_lock = Lock()


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    with _lock:
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="tabquorum-")
        return _local_roots[app]


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has been given."""
    return f"{shared_root(spark)}/tabquorum-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once and return the table read back, with its path.

    The read uses the frame's own schema, so column metadata (class names, vector
    sizes) survives.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def release(spark: SparkSession, path: str) -> None:
    """Delete one table that ``materialize`` wrote."""
    if "/tabquorum-" not in path:
        raise ValueError(f"not a table written by this package: {path}")
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
