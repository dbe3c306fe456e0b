"""Tables written to the cluster's shared folder, to cut lineage and to give the planner real sizes."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_root() -> str:
    return tempfile.mkdtemp(prefix="run-")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``. Only a local session may leave that unset; it then gets a folder of this process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = _own_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again: computed once, and it survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
