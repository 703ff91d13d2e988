"""Working folders that every executor can reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for shared intermediate data.

    Only a local session without the setting gets a temporary folder: on a cluster a
    machine-local folder would be invisible to the other executors.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="statweave-")
    spark.sparkContext.setCheckpointDir(folder)
    spark.conf.set(SETTING, folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used before, inside the shared folder."""
    return f"{shared_folder(spark)}/statweave/{uuid.uuid4().hex}/{name}"
