"""Where jobs may put data they have to write."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests) may fall back to a folder of this machine; on a cluster
    an unset folder is an error, because executors could not see each other's files. The local
    folder is removed when the process ends; the shared one belongs to the cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        root = tempfile.mkdtemp(prefix="plinth-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[context.applicationId] = root
    return _local_roots[context.applicationId]


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path below the scratch root."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once below the scratch root and read from there.

    For what several plans read: it cuts the plan, and a lost executor costs no more than a read.
    """
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    return back.select(*[F.col(f.name).alias(f.name, metadata=f.metadata) if f.metadata else F.col(f.name) for f in df.schema.fields])
