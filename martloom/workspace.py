"""Where jobs put intermediate and re-read files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused folder path under the cluster's shared checkpoint folder.

    Only a local-mode session without that setting may fall back to a machine-local folder: on a cluster the
    executors would each write to a disk the others cannot read.
    """
    leaf = f"{label}-{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/martloom/{leaf}"
    if spark.sparkContext.master.startswith("local"):
        return f"{tempfile.mkdtemp(prefix='martloom-')}/{leaf}"
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
