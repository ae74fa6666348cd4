"""Session helper: a shared work folder."""

import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder path that every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``; where that is
    unset, below the warehouse folder, which tables share anyway.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
